"""Reads of the day-partitioned lake: single days, ranges, record files, file inventory."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators.dedupe import dedupe_files
from garimpo.session import path_exists

DAY_PARTS = ("year", "month", "day")


TYPE_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
_opening = threading.RLock()


@contextmanager
def text_partitions(spark: SparkSession) -> Iterator[None]:
    """Open tables with partition values as text, whatever the session says.

    Inference would turn month "05" into 5 and version "2025-10" into a date. Partition values are
    resolved when a table is opened, so the setting is needed only for that moment. Threads that
    open tables of one session take turns.
    """
    with _opening:
        before = spark.conf.get(TYPE_INFERENCE)
        spark.conf.set(TYPE_INFERENCE, "false")
        try:
            yield
        finally:
            spark.conf.set(TYPE_INFERENCE, before)


def table_path(base: str, source: str) -> str:
    return f"{base.rstrip('/')}/{source}"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, folders: list[str] | None = None
) -> DataFrame:
    """All days of a table, or only the given partition folders; files are matched by column name.

    Without a schema every footer of what is opened is read to merge them; give one where there are
    many files. A schema names the partition columns too, as text.
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    with text_partitions(spark):
        return reader.parquet(path) if folders is None else reader.option("basePath", path).parquet(*folders)


def day_is(day: date) -> Column:
    """Partition predicate of one day. Values are compared as zero-padded text."""
    return (
        (F.col("year") == f"{day:%Y}") & (F.col("month") == f"{day:%m}") & (F.col("day") == f"{day:%d}")
    )


def partition_date() -> Column:
    """The day of a row's partition; null for rows that were written without a day."""
    return F.concat_ws("-", *DAY_PARTS).try_cast("date")


def day_folder(path: str, day: date) -> str:
    return f"{path.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def _open_days(spark: SparkSession, path: str, days: list[date], schema: T.StructType | str | None) -> DataFrame:
    """The table cut to the folders of some days: other days are neither listed nor opened."""
    folders = [f for f in (day_folder(path, day) for day in days) if path_exists(spark, f)]
    if folders:
        return read_table(spark, path, schema, folders)
    return read_table(spark, path, schema).where(F.lit(False))


def read_day(
    spark: SparkSession, path: str, day: date, id_col: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One day, whatever files hold it, first occurrence of each id."""
    return dedupe_files(_open_days(spark, path, [day], schema), id_col)


def read_days(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None,
    today: date | None = None, default_days: int = 30, schema: T.StructType | str | None = None,
) -> DataFrame:
    """An inclusive range of days; by default the last 30. Missing days simply add nothing.

    Only the folders of the range are opened. Rows written without a day belong to no range.
    """
    if end is None:
        end = today or date.today()
    if start is None:
        start = end - timedelta(days=default_days)
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    return _open_days(spark, path, days, schema)


def read_records_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """A JSON array of records, or objects wrapping it as ``{"data": [...]}``.

    One document per file is read whole by one task; with ``multi_line=False`` every line is a
    document and large files are split.
    """
    reader = spark.read.option("multiLine", multi_line)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if "data" in df.columns and isinstance(df.schema["data"].dataType, T.ArrayType):
        return df.select(F.explode("data").alias("__r")).select("__r.*")
    return df


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Every file below a path with size and modification time; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
