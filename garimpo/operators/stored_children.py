"""Children of records, stored by their parent's key: lists are gathered where the rows lie.

The rows are kept as a bucketed Parquet table. Grouping and joining on the key then reads one bucket per task
and exchanges nothing on the children's side; only the records move, which are few next to their items. Days
that come later are appended into the same buckets.

Rows are dealt to the writing tasks by AQE's rebalance on the key with as many partitions as buckets: small
buckets are written together, one file each, and a bucket in which a parent holds most rows becomes several
files. Gathering still makes one list of a parent's children, which is bound by what one record may hold.

A bucket is read by one task, so ``buckets_for`` takes their number from the expected size of the table. Spark
keeps the layout only where it has at least as many buckets as the session has shuffle partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators.nested import enrich_with_lists


def buckets_for(spark: SparkSession, expected_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets of about ``bucket_bytes``, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected_bytes // bucket_bytes))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame reads, from the file listing that the plan holds."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class StoredChildren:
    """Rows below ``path`` with ``schema``, in ``buckets`` buckets of ``keys``; lists are sorted by ``order``.

    The folder holds plain Parquet files; what the table is called in the session's catalog is of no account,
    so any session opens it with the same arguments. Rows with a null in a key have no parent and are not kept.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], buckets: int
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.table = f"children_{uuid.uuid4().hex}"
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet "
            f"CLUSTERED BY ({', '.join(map(_quoted, self.keys))}) INTO {buckets} BUCKETS LOCATION '{location}'")

    def append(self, children: DataFrame) -> "StoredChildren":
        rows = children.dropna(subset=self.keys).select(*(F.col(_quoted(f.name)) for f in self.schema))
        rows.hint("rebalance", self.buckets, *self.keys).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def lists(self, name: str) -> DataFrame:
        """One sorted array of structs per parent key; the order columns lead the struct."""
        rest = [f.name for f in self.schema if f.name not in self.keys and f.name not in self.order]
        entry = F.struct(*(F.col(_quoted(c)) for c in (*self.order, *rest)))
        return self.rows().groupBy(*self.keys).agg(F.sort_array(F.collect_list(entry)).alias(name))


def enrich_from_stored(
    records: DataFrame, items: StoredChildren, documents: StoredChildren, failed: DataFrame | None = None
) -> DataFrame:
    """``nested.enrich`` over stored children: records go to the buckets, no child row is exchanged.

    Both tables must have the records' key columns, of the same types, and the same number of buckets.
    """
    if (items.keys, items.buckets) != (documents.keys, documents.buckets):
        raise ValueError(f"buckets differ: {items.keys}, {items.buckets} and {documents.keys}, {documents.buckets}")
    kinds = {k: records.schema[k].dataType for k in items.keys}
    for stored in (items, documents):
        other = {k: stored.schema[k].dataType for k in items.keys if stored.schema[k].dataType != kinds[k]}
        if other:
            raise TypeError(f"key types of records {kinds} and children {other} differ: every child would be dealt again")
    # Without the hint small lists would be sent to all executors, which is an exchange as well.
    return enrich_with_lists(
        records, items.keys, items.lists("itens").hint("merge"), documents.lists("arquivos").hint("merge"), failed)
