"""Processed-id state and the run log, as partitioned Parquet tables.

State partitions are (source, detail_type, date, run). A run replaces its own partition when it
is repeated and never touches another run's, so no read-modify-write takes place. ``merge_runs``
turns the runs of a day into one partition; ``first_run`` keeps where an id came from.

With a commit log, only published partitions are opened: a run that broke off leaves ids that nobody
takes for known. Without one, whatever lies in the folders counts.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.cleaning import has_text
from garimpo.operators.commits import CommitLog, folder_value
from garimpo.session import remove_path

STATE_SCHEMA = (
    "id string, first_seen timestamp, first_run string, source string, detail_type string, date string, run string"
)
STATE_PARTS = ("source", "detail_type", "date", "run")
RUN_LOG_SCHEMA = (
    "date string, run_ts timestamp, input_rows long, new_rows long, duplicate_rows long, missing_id_rows long, "
    "invalid_rows long, undated_rows long, reported_new long, source string, detail_type string, run string"
)
RUN_LOG_PARTS = ("source", "detail_type", "run")
REQUIRED_LOG_FIELDS = ("source", "date", "run", "input_rows", "new_rows")
RECORDS, ITEMS, DOCUMENTS = "records", "itens", "arquivos"
# The state's day of records that have no time.
UNDATED = "undated"
MERGED = "merged-"


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty frame when it does not exist yet; other errors surface."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return _empty(spark, schema)
        raise


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, known as such when the plan is made: no task starts for them."""
    fields = (field.split(" ") for field in schema.split(", "))
    return spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in fields))


def ids_folder(source: str, detail_type: str, date: str | None = None, run: str | None = None) -> str:
    """Folder of the ids of a source, below the state's folder."""
    parts = [("source", source), ("detail_type", detail_type), ("date", date), ("run", run)]
    return "/".join(["ids", *(f"{name}={folder_value(value)}" for name, value in parts if value is not None)])


def log_folder(source: str, detail_type: str, run: str) -> str:
    parts = zip(RUN_LOG_PARTS, (source, detail_type, run))
    return "/".join(["runs", *(f"{name}={folder_value(value)}" for name, value in parts)])


class StateTable:
    """Ids and run log below ``base``; with ``commits``, a lake's log, ``base`` is a folder of that lake."""

    def __init__(self, spark: SparkSession, base: str, commits: CommitLog | None = None):
        self.spark = spark
        self.commits = commits
        self.base = base.rstrip("/")
        self.name = None if commits is None else self.base.removeprefix(commits.base).strip("/")
        self.ids_path = f"{self.base}/ids"
        self.log_path = f"{self.base}/runs"

    def _committed(self, table: str, schema: str, keep=lambda folder: True) -> DataFrame:
        folders = [f for f in self.commits.live(f"{self.name}/{table}") if keep(f)]
        if not folders:
            return _empty(self.spark, schema)
        top = f"{self.base}/{table.split('/')[0]}"
        reader = self.spark.read.schema(schema).option("basePath", top)
        return reader.parquet(*[f"{self.commits.base}/{f}" for f in folders])

    def ids(self, source: str, detail_type: str = RECORDS, date: str | None = None,
            before_run: str | None = None, dates: list[str] | None = None) -> DataFrame:
        """Processed ids with their day. ``before_run`` hides what that run itself added.

        With a commit log only the folders of the wanted ``dates`` are opened; the tree is not listed.
        """
        if self.commits is not None:
            days = None if dates is None else {f"/date={folder_value(d)}/" for d in dates}
            state = self._committed(
                ids_folder(source, detail_type, date), STATE_SCHEMA,
                lambda folder: days is None or any(d in f"{folder}/" for d in days))
        else:
            state = _read_or_empty(self.spark, self.ids_path, STATE_SCHEMA)
            if dates is not None:
                state = state.where(F.col("date").isin(dates))
        state = state.where((F.col("source") == source) & (F.col("detail_type") == detail_type))
        if date is not None:
            state = state.where(F.col("date") == date)
        if before_run is not None:
            state = state.where((F.col("run") != before_run) & ~F.col("first_run").eqNullSafe(before_run))
        return state

    def runs(self) -> DataFrame:
        if self.commits is not None:
            return self._committed("runs", RUN_LOG_SCHEMA)
        return _read_or_empty(self.spark, self.log_path, RUN_LOG_SCHEMA)

    def add(self, new_ids: DataFrame, source: str, run: str, detail_type: str = RECORDS,
            known_new: bool = False) -> None:
        """Union the ids of ``new_ids`` (columns ``id, date``) into the state.

        ``known_new`` says that the state filter has already passed, so it is not read again.
        """
        wanted = new_ids.select(F.col("id").cast("string").alias("id"), F.col("date").cast("string").alias("date"))
        if known_new:
            fresh = wanted.distinct()
        else:
            known = self.ids(source, detail_type, before_run=run)
            # Only the days of the batch: the join prunes the state's partitions.
            known = known.join(wanted.select("date").distinct(), "date", "left_semi")
            fresh = actually_new(wanted, known.select("id", "date"))
        rows = fresh.select(
            "id", F.current_timestamp().alias("first_seen"), F.lit(run).alias("first_run"), F.lit(source).alias("source"),
            F.lit(detail_type).alias("detail_type"), "date", F.lit(run).alias("run"),
        )
        writer = rows.hint("rebalance", "date").write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*STATE_PARTS).parquet(self.ids_path)

    def merge_runs(self, source: str, detail_type: str = RECORDS) -> int:
        """Turn the runs of every day into one partition, each id once with its first run; runs merged.

        With a commit log the merged partitions take the place of the old ones at once, and ``vacuum`` removes
        those later. Without one they are written before the old ones go; a crash in between leaves ids twice,
        which no reader minds. Run it while no ingestion of the same source is under way.
        """
        held = self.ids(source, detail_type)
        # Partition values only: one row per day and run of the source.
        runs = held.select("date", "run").distinct()
        several = runs.groupBy("date").agg(F.count("*").alias("n")).where("n > 1").select("date")
        old = runs.join(several, "date", "left_semi").collect()
        if not old:
            return 0
        merged_run = MERGED + uuid.uuid4().hex
        merged = held.join(several, "date", "left_semi").groupBy("source", "detail_type", "date", "id").agg(
            F.min(F.struct("first_seen", "first_run")).alias("first"))
        rows = merged.select("id", "first.first_seen", "first.first_run", "source", "detail_type", "date",
                             F.lit(merged_run).alias("run"))
        rows.hint("rebalance", "date").write.mode("append").partitionBy(*STATE_PARTS).parquet(self.ids_path)
        gone = [ids_folder(source, detail_type, r["date"], r["run"]) for r in old]
        if self.commits is None:
            return sum(remove_path(self.spark, f"{self.base}/{folder}") for folder in gone)
        adds = {f"{self.name}/{ids_folder(source, detail_type, r['date'], merged_run)}" for r in old}
        self.commits.publish(merged_run, adds, [f"{self.name}/{folder}" for folder in gone])
        return len(gone)

    def log(self, entries: DataFrame) -> None:
        """Write run-log rows; the required fields must be there."""
        missing = [f for f in REQUIRED_LOG_FIELDS if f not in entries.columns]
        if missing:
            raise ValueError(f"run log entry lacks {missing}")
        absent = {"detail_type": F.lit(RECORDS)}
        full = entries.select(*(
            (F.col(name) if name in entries.columns else absent.get(name, F.lit(None))).cast(kind).alias(name)
            for name, kind in (field.split(" ") for field in RUN_LOG_SCHEMA.split(", "))
        ))
        writer = full.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*RUN_LOG_PARTS).parquet(self.log_path)


def actually_new(new_ids: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct (id, date) pairs that the state does not hold yet."""
    fresh = new_ids.where(has_text(F.col("id"))).distinct()
    return fresh.join(known, ["id", "date"], "left_anti")


def state_summary(state: DataFrame, runs: DataFrame) -> DataFrame:
    """Per (source, day): ids held, runs, first and last run, and new ids over all runs.

    ``total_new_reported`` takes the figure a caller reported over the counted one, which is why
    it may exceed the number of ids.
    """
    held = state.groupBy("source", "date").agg(F.count("*").alias("total_processed"))
    reported = F.coalesce(F.col("reported_new"), F.col("new_rows"))
    ran = runs.groupBy("source", "date").agg(
        F.count("*").alias("total_executions"),
        F.min("run_ts").alias("first_execution"),
        F.max("run_ts").alias("last_execution"),
        F.sum("new_rows").alias("total_new"),
        F.sum(reported).alias("total_new_reported"),
    )
    return ran.join(held, ["source", "date"], "full").fillna(
        0, ["total_processed", "total_executions", "total_new", "total_new_reported"]
    )
