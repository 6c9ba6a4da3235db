"""Writers of the bronze, silver and gold layers.

Every bronze write of a run lands in its own ``run=`` folder below the day and replaces what
an earlier attempt of the same run left there, so a retried run cannot duplicate rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions.timeparts import partition_parts
from garimpo.sources.lake import DAY_PARTS, table_path

RUN = "run"


def write_bronze(
    df: DataFrame, base: str, source: str, at: Column, run: str, fmt: str = "parquet",
    max_records_per_file: int = 0,
) -> str:
    """Write by local business day of ``at`` (a UTC time column or literal); return the path.

    Rows without a time go to the default partition, whose year, month and day read as null.
    """
    path = table_path(base, source)
    placed = df.withColumns({**partition_parts(at), RUN: F.lit(run)})
    # Few files per day, yet a day holding most rows is split over tasks by AQE.
    placed = placed.hint("rebalance", *DAY_PARTS)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy(*DAY_PARTS, RUN).option("maxRecordsPerFile", max_records_per_file)
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown bronze format {fmt!r}")
    return path


def write_silver(df: DataFrame, base: str, table: str, partition_cols: Sequence[str] = ()) -> str:
    """Replace the written partitions of a silver table, or the whole table without partitions."""
    path = table_path(base, table)
    clustered = df.hint("rebalance", *partition_cols) if partition_cols else df
    writer = clustered.write.mode("overwrite").option("compression", "snappy")
    if partition_cols:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    writer.parquet(path)
    return path


def write_gold(df: DataFrame, base: str, feature_set: str) -> str:
    path = table_path(base, feature_set)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_registry(df: DataFrame, base: str, entity: str, version: str) -> str:
    """One snapshot per version; writing a version again replaces it."""
    path = table_path(base, entity)
    writer = df.withColumn("version", F.lit(version)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)
    return path


def write_metadata(written: DataFrame, layer: str, by: Sequence[str] = ()) -> DataFrame:
    """What a write left behind: record count, columns and column count.

    Counted on the written table, not with accumulators, which retried stages would inflate.
    """
    names = [c for c in written.columns if c not in (*DAY_PARTS, RUN)]
    return written.groupBy(*by).agg(F.count("*").alias("record_count")).withColumns({
        "layer": F.lit(layer),
        "columns": F.lit(",".join(names)),
        "feature_count": F.lit(len(names)),
    })


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    """Report rows as JSON lines; non-ASCII text stays readable."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
