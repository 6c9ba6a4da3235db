"""Compaction and clean-up of day partitions.

Compaction writes the merged rows as a new run of the day. In a lake with a commit log it then publishes the
new run in place of those it read, so readers see every row once at any moment. In a plain folder it removes
the runs it read; a crash in between leaves rows twice, which readers drop by id and the next compaction
merges. No step can lose a row.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.operators.commits import NO_VALUE, CommitLog, folder_value
from garimpo.operators.dedupe import FILE_ORDER, keep_first, with_file_order
from garimpo.operators.sinks import RUN
from garimpo.session import fresh_path, path_exists, remove_path
from garimpo.sources.lake import DAY_PARTS, day_folder, inventory, partition_date, read_table, text_partitions

TARGET_FILE_BYTES = 128 << 20
COMPACTED = "compact-"


def _delete(spark: SparkSession, folders: Sequence[str]) -> int:
    """Remove folders; absent ones do not count."""
    return sum(remove_path(spark, folder) for folder in folders)


def _days(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        df = df.where(partition_date() >= F.lit(start))
    if end is not None:
        df = df.where(partition_date() <= F.lit(end))
    return df


def _same_day(left: str, right: str) -> list[Column]:
    """Day parts meet null-safely: rows written without a day are a partition as well."""
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in DAY_PARTS]


def _identity(table: DataFrame, id_col: str | None) -> list[str]:
    """The id, or all data columns of a table that has none."""
    if id_col is not None and id_col in table.columns:
        return [id_col]
    return [c for c in table.columns if c not in (*DAY_PARTS, RUN)]


def compaction_stats(table: DataFrame, id_col: str | None, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Per day: files, bytes, rows, rows after deduplication, and whether there is work to do.

    There is work when rows repeat, or when several files are on average below half the target. A
    compacted day has neither, however many files its size asks for. A table without the id column
    is judged by whole rows.
    """
    by_file = table.select(
        *DAY_PARTS, F.xxhash64(*_identity(table, id_col)).alias("__h"), F.struct(*_identity(table, id_col)).alias("id"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
    )
    files = by_file.groupBy(*DAY_PARTS, "file").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    sizes = files.groupBy(*DAY_PARTS).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("total_before")
    )
    ids = by_file.groupBy(*DAY_PARTS, "__h", "id").agg(F.count("*").alias("n"))
    unique = ids.groupBy(*DAY_PARTS).agg(F.count("*").alias("total_after"))
    stats = sizes.alias("s").join(unique.alias("u"), _same_day("s", "u")).select("s.*", "total_after")
    small = (F.col("files") > 1) & (F.col("bytes") < F.col("files") * (target_bytes / 2))
    return stats.withColumns({
        "duplicates_removed": F.col("total_before") - F.col("total_after"),
        "needs_work": small | (F.col("total_before") > F.col("total_after")),
    })


def compact(
    spark: SparkSession, path: str, id_col: str | None, start: date | None = None, end: date | None = None,
    dry_run: bool = False, target_bytes: int = TARGET_FILE_BYTES, commits: CommitLog | None = None,
) -> DataFrame:
    """Merge the files of each day that needs it, first occurrence of an id kept; return stats.

    A day becomes ``ceil(bytes / target)`` files written by as many tasks, so a small day ends in
    one file and a huge one is never squeezed through a single task. Without an id column identical
    rows collapse. Rows without a day are compacted in their own partition when no range is given.

    With the lake's commit log only published runs are read and replaced, as one entry; if another writer
    replaced them meanwhile, ``Conflict`` is raised and nothing changes.
    """
    path = path.rstrip("/")
    name = None if commits is None else path.removeprefix(commits.base).strip("/")
    found = read_table(spark, path) if commits is None else commits.read(name)
    if found is None:
        found = read_table(spark, path).where(F.lit(False))
    table = _days(found, start, end)
    kept = fresh_path(spark, "compaction")
    compaction_stats(table, id_col, target_bytes).write.parquet(kept)
    with text_partitions(spark):
        result = spark.read.parquet(kept)
    work = result.where("needs_work")
    if dry_run or work.isEmpty():
        return result
    # The bytes that will be left, as far as the removed rows tell.
    expected = F.col("bytes") * F.col("total_after") / F.col("total_before")
    work = work.select(*DAY_PARTS, F.greatest(F.lit(1), F.ceil(expected / target_bytes)).cast("int").alias("__files"))
    # File columns exist on the scan only, hence before the join.
    dirty = with_file_order(table).alias("t").join(work.alias("w"), _same_day("t", "w")).select("t.*", "__files")
    # One row per day and run: partition folders, not table data.
    old_runs = dirty.select(*DAY_PARTS, RUN).distinct().collect()
    identity = _identity(table, id_col)
    if identity == [id_col]:
        merged = keep_first(dirty, [*DAY_PARTS, id_col], FILE_ORDER).drop(*FILE_ORDER)
    else:
        merged = dirty.drop(*FILE_ORDER, RUN).dropDuplicates()
    slot = F.pmod(F.xxhash64(*identity), F.col("__files"))
    placed = merged.withColumn("__slot", slot).repartition(*DAY_PARTS, "__slot").drop("__slot", "__files")
    run = COMPACTED + uuid.uuid4().hex
    writer = placed.withColumn(RUN, F.lit(run)).write.mode("append").option("compression", "snappy")
    writer.partitionBy(*DAY_PARTS, RUN).parquet(path)
    days = ["/".join(f"{c}={NO_VALUE if r[c] is None else r[c]}" for c in DAY_PARTS) for r in old_runs]
    old = [f"{day}/{RUN}={folder_value(r[RUN])}" for day, r in zip(days, old_runs)]
    if commits is None:
        _delete(spark, [f"{path}/{folder}" for folder in old])
    else:
        commits.publish(run, {f"{name}/{day}/{RUN}={run}" for day in days}, [f"{name}/{folder}" for folder in old])
    return result


def clean_day(spark: SparkSession, folders: Sequence[str], dry_run: bool = False) -> DataFrame:
    """Files and megabytes below each folder of a day; removes the folders unless dry."""
    found = None
    present = []
    for folder in folders:
        if not path_exists(spark, folder):
            continue
        present.append(folder)
        files = inventory(spark, folder).select(F.lit(folder).alias("prefix"), "length")
        found = files if found is None else found.unionAll(files)
    schema = "prefix string, files long, size_mb double"
    if found is None:
        return spark.createDataFrame([], schema)
    per_folder = found.groupBy("prefix").agg(
        F.count("*").alias("files"), (F.sum("length") / (1024 * 1024)).alias("size_mb")
    )
    # One row per folder of the day; fixed before the files go away.
    result = spark.createDataFrame(per_folder.toArrow())
    if not dry_run:
        _delete(spark, present)
    return result


def day_folders(base: str, day: date, tables: Sequence[str], sources: Sequence[str], detail_types: Sequence[str]) -> list[str]:
    """What one day left below a lake: its data in the given tables and its ids in the state."""
    data = [day_folder(f"{base.rstrip('/')}/{table}", day) for table in tables]
    state = [
        f"{base.rstrip('/')}/state/ids/source={s}/detail_type={d}/date={day:%Y-%m-%d}" for s in sources for d in detail_types
    ]
    return data + state
