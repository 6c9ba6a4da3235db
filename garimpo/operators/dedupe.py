"""Keep-first deduplication and filters against already-processed ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.cleaning import has_text, present

FILE_ORDER = ("__file", "__row")


def with_file_order(df: DataFrame) -> DataFrame:
    """Listing order of file-based rows: file name, then row inside the file."""
    return df.withColumns({
        "__file": F.col("_metadata.file_path"),
        "__row": F.col("_metadata.row_index"),
    })


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle too, so
    each map task sends at most one row per key and a hot key costs nothing extra.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def dedupe_batch(
    df: DataFrame, id_col: str, order: Sequence[str | Column], seen: DataFrame | None = None
) -> DataFrame:
    """Drop rows without id, keep the first row of each id, leave out ids seen earlier.

    ``seen`` is the memory of earlier calls: a frame whose first column is the id.
    """
    first = keep_first(df.where(present(df, F.col(id_col))), [id_col], order)
    return first if seen is None else without_ids(first, F.col(id_col), seen)


def dedupe_files(df: DataFrame, id_col: str, whole_row: bool = False) -> DataFrame:
    """Union of files, first occurrence of each id in listing order.

    Rows with a null id form one group, as in a column-wise drop of duplicates. Without an id
    column rows stay as they are, or identical rows collapse when ``whole_row`` is set.
    """
    if id_col in df.columns:
        return keep_first(with_file_order(df), [id_col], FILE_ORDER).drop(*FILE_ORDER)
    return df.dropDuplicates() if whole_row else df


def without_ids(df: DataFrame, key: Column, seen: DataFrame) -> DataFrame:
    """Anti join on the first column of ``seen``. No broadcast is forced: state grows."""
    ids = seen.select(F.col(seen.columns[0]).alias("__seen"))
    return df.join(ids, key == F.col("__seen"), "left_anti")


def new_records(df: DataFrame, key: Column, processed: DataFrame) -> DataFrame:
    """Rows with an id that the processed set does not hold; duplicates inside the batch pass."""
    return without_ids(df.where(present(df, key)), key, processed)


def flag_new(df: DataFrame, key: Column | Sequence[Column], processed: DataFrame, name: str) -> DataFrame:
    """Like ``new_records`` but keeps every row and adds the answer as a boolean.

    A key of several columns meets the first columns of ``processed`` in the same order.
    """
    keys = [key] if isinstance(key, Column) else list(key)
    held = [f"__seen{i}" for i in range(len(keys))]
    ids = processed.select(*(F.col(c).alias(h) for c, h in zip(processed.columns, held))).distinct()
    joined = df.join(ids, [k == F.col(h) for k, h in zip(keys, held)], "left")
    complete = F.lit(True)
    for k in keys:
        complete = complete & has_text(k)
    return joined.withColumn(name, complete & F.col(held[0]).isNull()).drop(*held)


def filter_stats(flagged: DataFrame, is_new: str, key: Column, by: Sequence[str] = ()) -> DataFrame:
    """Totals of a state filter in one aggregate.

    ``already_processed`` counts everything that was not kept, rows without id included;
    those are also shown on their own.
    """
    kept = F.sum(F.col(is_new).cast("long"))
    total = F.count("*")
    stats = flagged.groupBy(*by).agg(
        total.alias("total_input"),
        F.coalesce(total - kept, F.lit(0)).alias("already_processed"),
        F.coalesce(kept, F.lit(0)).alias("new_records"),
        F.coalesce(F.sum((~has_text(key)).cast("long")), F.lit(0)).alias("missing_id"),
    )
    rate = F.round(F.col("already_processed") / F.col("total_input") * 100, 2)
    return stats.withColumn(
        "filter_rate", F.when(F.col("total_input") > 0, rate).otherwise(F.lit(0.0))
    )


def needs_details(df: DataFrame, key: Column, items_done: DataFrame, documents_done: DataFrame) -> DataFrame:
    """Rows still lacking items or documents, with one flag for each."""
    flagged = flag_new(df, key, items_done, "needs_items")
    flagged = flag_new(flagged, key, documents_done, "needs_documents")
    return flagged.where("needs_items or needs_documents")


def resume_batch(
    df: DataFrame, key: Column, items_done: DataFrame, order: Sequence[str | Column],
    batch_size: int | None = None, max_records: int | None = None,
) -> DataFrame:
    """Unprocessed rows, cut to the batch size (or else the test limit) in the given order."""
    rest = new_records(df, key, items_done)
    limit = batch_size or max_records
    return rest.orderBy(*order).limit(limit) if limit else rest
