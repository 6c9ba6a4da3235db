"""Attach item and document lists to records, and read lists back for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.functions.cleaning import has_text

# Bytes of input files behind one task that counts rows by their parent.
ROWS_BYTES = 2 << 20
KEY_ERROR = "Missing cnpj/ano/sequencial"


def parts_for(df: DataFrame, part_bytes: int) -> int:
    """Tasks for parts of about ``part_bytes`` of input files, no fewer than the session's shuffle partitions."""
    # A leaf of unknown size says a number beyond any table.
    sizes = [int(str(leaf.stats().sizeInBytes())) for leaf in _leaves(df)]
    wanted = -(-sum(s for s in sizes if s < 1 << 60) // part_bytes)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(wanted, 1 << 16))


def _leaves(df: DataFrame) -> list:
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def truthy(col: Column, dtype: T.DataType) -> Column:
    """Present and neither empty text nor zero; never null."""
    if isinstance(dtype, T.NumericType):
        return F.coalesce(col != 0, F.lit(False))
    return has_text(col)


def company_of(df: DataFrame) -> Column:
    """``cnpj`` when filled, else the one inside ``orgaoEntidade``."""
    nested = F.col("orgaoEntidade.cnpj") if "orgaoEntidade" in df.columns else F.lit(None).cast("string")
    if "cnpj" not in df.columns:
        return nested
    return F.when(has_text(F.col("cnpj")), F.col("cnpj")).otherwise(nested)


def child_lists(children: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """One sorted array of structs per parent key; the order columns lead the struct.

    A list is one row of the result, so its size is bound by what one record may hold. Collecting
    before the shuffle would not shrink anything, hence the rows move first; a join on the same
    keys finds them in place.
    """
    rest = [c for c in children.columns if c not in keys and c not in order]
    entry = F.struct(*order, *rest)
    return children.dropna(subset=list(keys)).repartition(*keys).groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(name))


def enrich(
    records: DataFrame, keys: Sequence[str], items: DataFrame, documents: DataFrame,
    item_order: Sequence[str], document_order: Sequence[str], failed: DataFrame | None = None,
) -> DataFrame:
    """Records with ``itens``, ``arquivos`` and ``metadata``; no record is dropped.

    A record whose key is incomplete gets empty lists and an error and counts as no call.
    ``failed`` (keys plus ``error``) names records whose lists could not be read.
    """
    return enrich_with_lists(
        records, keys, child_lists(items, keys, item_order, "itens"),
        child_lists(documents, keys, document_order, "arquivos"), failed)


def enrich_with_lists(
    records: DataFrame, keys: Sequence[str], items: DataFrame, documents: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """``enrich`` from lists: one row per key, with the column ``itens`` or ``arquivos``."""
    out = _judged(records, keys, failed)
    out = out.join(items, list(keys), "left").join(documents, list(keys), "left")
    for name in ("itens", "arquivos"):
        out = out.withColumn(name, F.when(F.col("__usable"), F.coalesce(name, F.array())).otherwise(F.array()))
    return out.withColumn("metadata", _metadata(F.size("itens"), F.size("arquivos"))).drop(*_JUDGED)


_JUDGED = ("__complete", "__usable", "__error")


def _judged(records: DataFrame, keys: Sequence[str], failed: DataFrame | None) -> DataFrame:
    """Records with whether their key is complete, their lists usable, and why not."""
    kinds = {f.name: f.dataType for f in records.schema.fields}
    complete = F.lit(True)
    for k in keys:
        complete = complete & truthy(F.col(k), kinds[k])
    out = records
    known = F.lit(None).cast("string")
    if failed is not None:
        out = out.join(failed.groupBy(*keys).agg(F.min("error").alias("__failed")), list(keys), "left")
        known = F.col("__failed")
    return out.withColumns({
        "__complete": complete, "__usable": complete & known.isNull(),
        "__error": F.coalesce(F.when(~complete, F.lit(KEY_ERROR)), known),
    }).drop("__failed")


def _metadata(items: Column, documents: Column) -> Column:
    return F.struct(
        items.alias("total_itens"),
        documents.alias("total_arquivos"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("fetch_timestamp"),
        F.when(F.col("__complete"), 2).otherwise(0).alias("api_calls"),
        F.col("__error").alias("fetch_error"),
    )


def enrichment_counts(
    records: DataFrame, keys: Sequence[str], items: DataFrame, documents: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """Records with the ``metadata`` that ``enrich`` would give them, without gathering any list."""
    def counted(children: DataFrame, name: str) -> DataFrame:
        return children.groupBy(*keys).agg(F.count("*").cast("int").alias(name))

    out = _judged(records, keys, failed)
    out = out.join(counted(items, "__items"), list(keys), "left").join(counted(documents, "__documents"), list(keys), "left")
    sizes = [F.when(F.col("__usable"), F.coalesce(n, F.lit(0))).otherwise(0) for n in ("__items", "__documents")]
    return out.withColumn("metadata", _metadata(*sizes)).drop(*_JUDGED, "__items", "__documents")


def child_labels(
    records: DataFrame, keys: Sequence[str], children: DataFrame, labels: Sequence[str], failed: DataFrame | None = None
) -> DataFrame:
    """Children of usable records by their labels: the label columns and ``n``.

    Children are counted per parent and labels before they meet the records; no list is gathered. Parents have
    few children of one kind, so the rows move before they are counted: a table of them ahead of the shuffle
    would hold nearly every row. A task counts about ROWS_BYTES of input, however much there is. Keys shrink much
    in a shuffle, so parents that look small enough to be sent to every task are not: each would hold them all.
    """
    children = children.dropna(subset=list(keys)).select(*keys, *labels).repartition(
        parts_for(children, ROWS_BYTES), *keys)
    counted = children.groupBy(*keys, *labels).agg(F.count("*").alias("__n"))
    parents = _judged(records, keys, failed).where("__usable").select(*keys)
    return counted.join(parents.hint("merge"), list(keys)).groupBy(*labels).agg(F.sum("__n").alias("n"))


def enrichment_totals(enriched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Processed records, items, documents, calls and errors."""
    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    return enriched.groupBy(*by).agg(
        F.count("*").alias("processed"),
        total(F.col("metadata.total_itens")).alias("total_itens"),
        total(F.col("metadata.total_arquivos")).alias("total_arquivos"),
        total(F.col("metadata.api_calls")).alias("api_calls"),
        F.count("metadata.fetch_error").alias("errors"),
    )


def list_size(name: str) -> Column:
    """Length of a list column; a missing list counts as empty."""
    return F.coalesce(F.size(name), F.lit(0)) if name else F.lit(0)


def flatten(df: DataFrame, name: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """One row per list entry, its fields as columns next to the kept ones."""
    entry = F.explode_outer(name) if outer else F.explode(name)
    return df.select(*keep, entry.alias("__entry")).select(*keep, "__entry.*")
