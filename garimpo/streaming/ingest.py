"""Incremental ingestion as Structured Streaming: new records only, data, state and log published at once."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.cleaning import has_text, present
from garimpo.functions.timeparts import to_local
from garimpo.operators.commits import NO_VALUE, CommitLog, folder_value
from garimpo.operators.dedupe import flag_new, keep_first
from garimpo.operators.filters import add_metadata
from garimpo.operators.sinks import RUN, write_bronze
from garimpo.operators.state import RECORDS, RUN_LOG_SCHEMA, UNDATED, StateTable, ids_folder, log_folder
from garimpo.operators.validate import with_errors
from garimpo.session import fresh_path, remove_path
from garimpo.sources.lake import DAY_PARTS, read_table


@dataclass(frozen=True)
class Ingest:
    """What to ingest and where to.

    ``at`` is the UTC time column that names the record's day. With ``dedupe`` the first row of an
    id wins inside a batch (by ``order``); without it duplicates inside one batch all pass.
    """

    spark: SparkSession
    base: str
    source: str
    id_col: str
    at: str
    order: tuple[str, ...]
    dedupe: bool = True
    detail_type: str = RECORDS
    date_col: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None

    @property
    def table(self) -> str:
        """Records are in the source's own table, every other detail type has one next to it."""
        return self.source if self.detail_type == RECORDS else f"{self.source}-{self.detail_type}"

    @cached_property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, self.base)

    @property
    def state(self) -> StateTable:
        return StateTable(self.spark, f"{self.base}/state", self.commits)

    def read(self, schema=None) -> DataFrame:
        """The table as published: whole runs only, whatever else its folders hold."""
        found = self.commits.read(self.table, schema)
        return read_table(self.spark, f"{self.base}/{self.table}", schema).where(F.lit(False)) if found is None else found


def ingest_batch(job: Ingest, batch: DataFrame, run: str) -> None:
    """Filter, validate, stamp, write data, state and the run log, then publish the three as one entry.

    Until then nobody opens what was written: an attempt that breaks off adds no row, no known id and no log
    line, and its files are replaced by the next one. A run that was published is not repeated. Records
    without a time are kept: they go to the table's default partition, and the state remembers their ids
    under a day of its own. Only the state's folders of the batch's days are opened. The driver holds one row
    per day of the batch.
    """
    key = f"{job.source}/{job.detail_type}/{run}"
    if job.commits.published(key):
        return
    day = F.coalesce(F.date_format(to_local(F.col(job.at)), "yyyy-MM-dd"), F.lit(UNDATED))
    rows = batch.withColumn("__day", day)
    ided = rows.where(present(rows, F.col(job.id_col)))
    if job.dedupe:
        ided = keep_first(ided, ["__day", job.id_col], list(job.order))
    checked = with_errors(ided, job.id_col, job.date_col or "__none")
    days = [r[0] for r in rows.select("__day").distinct().collect()]
    known = job.state.ids(job.source, job.detail_type, dates=days)
    keys = [F.col("__day"), F.col(job.id_col).cast("string")]
    # The ids of all runs stay where they are: sent to every executor they would pass the driver with each batch.
    flagged = flag_new(checked, keys, known.select("date", "id").hint("merge"), "__new")
    # What the writes share is written once to the shared folder, where a lost executor cannot take it.
    staged = fresh_path(job.spark, "ingest")
    flagged.withColumn("__invalid", F.size("errors") > 0).drop("errors").write.parquet(staged)
    flagged = job.spark.read.parquet(staged)
    try:
        fresh = flagged.where("__new").drop("__new", "__day", "__invalid")
        if job.transform is not None:
            fresh = job.transform(fresh)
        stamped = add_metadata(fresh, {"source": job.source, "run": run})
        write_bronze(stamped, job.base, job.table, F.col(job.at), run)
        new_ids = flagged.where("__new").select(
            F.col(job.id_col).cast("string").alias("id"), F.col("__day").alias("date")
        )
        job.state.add(new_ids, job.source, run, job.detail_type, known_new=True)
        logged = _run_log(job, rows, flagged, run).collect()
        if not logged:
            return
        fields = [f for f in RUN_LOG_SCHEMA.split(", ") if f.split(" ")[0] in logged[0]]
        job.state.log(_as_frame(job.spark, logged, fields))
        job.commits.publish(key, _written(job, run, [r["date"] for r in logged if r["new_rows"]]))
    finally:
        remove_path(job.spark, staged)


def _as_frame(spark: SparkSession, rows: list, fields: list[str]) -> DataFrame:
    """Collected log rows as a local table; no Python worker starts for them. They share one time of the run."""
    names = [f.split(" ")[0] for f in fields]
    kinds = ", ".join(f for f in fields if f != "run_ts timestamp")
    text = json.dumps([{n: r[n] for n in names if n != "run_ts"} for r in rows])
    entries = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kinds.replace(' ', ': ').replace(',: ', ', ')}>>")))
    return entries.withColumn("run_ts", F.lit(rows[0]["run_ts"])).select(*names)


def _written(job: Ingest, run: str, days: list[str]) -> list[str]:
    """Folders that a run wrote, relative to the lake. A transformation may have left a day without rows."""
    data = []
    for day in days:
        parts = [NO_VALUE] * 3 if day == UNDATED else day.split("-")
        placed = [*zip(DAY_PARTS, parts), (RUN, folder_value(run))]
        data.append("/".join([job.table, *(f"{name}={value}" for name, value in placed)]))
    state = [f"state/{ids_folder(job.source, job.detail_type, day, run)}" for day in days]
    return [*job.commits.existing(data), *state, f"state/{log_folder(job.source, job.detail_type, run)}"]


def _run_log(job: Ingest, rows: DataFrame, flagged: DataFrame, run: str) -> DataFrame:
    """One log row per day of the batch."""
    counted = rows.groupBy(F.col("__day").alias("date")).agg(
        F.count("*").alias("input_rows"),
        F.sum((~has_text(F.col(job.id_col))).cast("long")).alias("missing_id_rows"),
        F.sum((F.col("__day") == UNDATED).cast("long")).alias("undated_rows"),
    )
    kept = flagged.groupBy(F.col("__day").alias("date")).agg(
        F.sum(F.col("__new").cast("long")).alias("new_rows"),
        F.sum((F.col("__new") & F.col("__invalid")).cast("long")).alias("invalid_rows"),
    )
    # Days of kept rows are among those of the input, so both meet in one sum per day.
    names = ["input_rows", "missing_id_rows", "undated_rows", "new_rows", "invalid_rows"]
    both = counted.unionByName(kept, allowMissingColumns=True).groupBy("date").agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return both.select(
        F.lit(job.source).alias("source"), F.lit(job.detail_type).alias("detail_type"), "date",
        F.lit(run).alias("run"), F.current_timestamp().alias("run_ts"), "input_rows", "new_rows",
        (F.col("input_rows") - F.col("new_rows")).alias("duplicate_rows"),
        "missing_id_rows", "invalid_rows", "undated_rows",
    )


def run_stream(job: Ingest, stream: DataFrame, checkpoint: str) -> None:
    """Process everything that has arrived, in batches, and stop.

    The checkpoint remembers which files are done; the state remembers which ids are. Runs are
    named after the query's id, which Spark keeps in the checkpoint: a repeated batch has its old
    name, and two checkpoints on one lake never share one.
    """
    known = threading.Event()
    query: list = []

    def each(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        ingest_batch(job, batch, f"{job.table}-{query[0].id}-{batch_id:09d}")

    started = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.append(started)
    known.set()
    started.awaitTermination()


def landing_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files landing in a folder; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def bounded_distinct(stream: DataFrame, id_col: str, at: str, delay: str) -> DataFrame:
    """One row per (id, day) with state bounded by a watermark on the day.

    Not equal to the state-table route: rows later than ``delay`` are dropped.
    """
    daily = stream.withColumn("day", F.date_trunc("day", F.col(at).cast("timestamp")))
    return daily.withWatermark("day", delay).dropDuplicates([id_col, "day"])
