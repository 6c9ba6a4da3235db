"""Queries: processed-id state and incremental ingestion as streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from garimpo.operators import history, nested
from garimpo.operators.carried import CarriedHistory
from garimpo.operators.commits import CommitLog
from garimpo.operators.maintain import compact
from garimpo.operators.running import range_bucket
from garimpo.operators.state import StateTable, state_summary
from garimpo.operators.stored_children import StoredChildren, buckets_for, enrich_from_stored, input_bytes
from garimpo.plans import reporting, silver
from garimpo.plans.registry import REGISTRY, Tables, query
from garimpo.plans.shapes import KEYS, attachments, items, records
from garimpo.session import fresh_path
from garimpo.sources.lake import partition_date
from garimpo.streaming.ingest import Ingest, ingest_batch, landing_stream, run_stream


def _three_runs(t: Tables) -> StateTable:
    """Orders by status in three runs of growing overlap, the day being the first of the year."""
    state = StateTable(t.spark, fresh_path(t.spark, "state"))
    ids = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"), F.trunc("o_orderdate", "year").cast("string").alias("date"),
        "o_orderstatus", F.col("o_totalprice").alias("price"))
    for run, wanted in (("r1", ["F"]), ("r2", ["F", "O"]), ("r3", ["F", "O", "P"])):
        batch = ids.where(F.col("o_orderstatus").isin(*wanted))
        state.add(batch, "orders", run)
        added = state.ids("orders").where(F.col("run") == run)
        counted = batch.groupBy("date").agg(F.count("*").alias("input_rows"))
        entries = counted.join(added.groupBy("date").agg(F.count("*").alias("new_rows")), "date", "left").fillna(0)
        state.log(entries.select(
            F.lit("orders").alias("source"), "date", F.lit(run).alias("run"), F.current_timestamp().alias("run_ts"),
            "input_rows", "new_rows", F.when(F.lit(run) == "r3", F.col("input_rows")).alias("reported_new")))
    return state


@query("I2 I3 I4 I6", """
SELECT strftime(o_orderdate, '%Y-01-01') AS date, 'orders' AS source, count(*) AS total_processed, 3 AS total_executions,
  count(*) AS total_new, count(*) + count(*) FILTER (o_orderstatus <> 'P') AS total_new_reported
FROM orders GROUP BY 1""")
def state_summary_by_day(t: Tables):
    state = _three_runs(t)
    summary = state_summary(state.ids("orders"), state.runs())
    return summary.select("date", "source", "total_processed", "total_executions", "total_new", "total_new_reported")


@query("I4 I5", """SELECT o_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-01-01') AS date,
CASE o_orderstatus WHEN 'F' THEN 'r1' WHEN 'O' THEN 'r2' ELSE 'r3' END AS run FROM orders""")
def processed_ids(t: Tables):
    return _three_runs(t).ids("orders").select("id", "date", "run")


def _landed_events(t: Tables, rows: str = "true") -> str:
    """Events in a folder per type: several files, cut by the scan and without regard to time."""
    path = fresh_path(t.spark, "landing")
    t.events.where(rows).write.partitionBy("event_type").parquet(path)
    return path


def _event_job(t: Tables) -> Ingest:
    return Ingest(t.spark, fresh_path(t.spark, "lake"), "events", "user_id", "ts", ("event_id",))


def _stream_events(t: Tables, files_per_batch: int) -> Ingest:
    job = _event_job(t)
    stream = landing_stream(t.spark, _landed_events(t), t.events.schema, files_per_batch=files_per_batch)
    run_stream(job, stream, fresh_path(t.spark, "checkpoint"))
    return job


LOCAL_DAY_SQL = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Sao_Paulo')::DATE"


@query("T1 T2 T4", f"SELECT DISTINCT {LOCAL_DAY_SQL} AS date, user_id FROM events")
def streamed_new_records(t: Tables):
    job = _stream_events(t, files_per_batch=2)
    return job.read().select(partition_date().alias("date"), "user_id")


@query("T1 I4 I5", f"""
SELECT {LOCAL_DAY_SQL} AS date, user_id, 1::BIGINT AS rows, 1::BIGINT AS states FROM events GROUP BY 1, 2""")
def two_checkpoints(t: Tables):
    """Two streams with checkpoints of their own feed one lake: neither replaces what the other wrote."""
    job = _event_job(t)
    for rows in ("event_type <> 'purchase'", "event_type <> 'click'"):
        stream = landing_stream(t.spark, _landed_events(t, rows), t.events.schema, files_per_batch=2)
        run_stream(job, stream, fresh_path(t.spark, "checkpoint"))
    day = partition_date().alias("date")
    data = job.read().groupBy(day, "user_id").agg(F.count("*").alias("rows"))
    job.state.merge_runs("events")
    held = job.state.ids("events").groupBy(
        F.col("date").cast("date").alias("date"), F.col("id").cast("long").alias("user_id")).agg(F.count("*").alias("states"))
    return data.join(held, ["date", "user_id"], "full")


@query("T3 I2 D4", f"""
WITH d AS (SELECT {LOCAL_DAY_SQL} AS date, event_type, user_id FROM events)
SELECT strftime(date, '%Y-%m-%d') AS date, 'itens' AS detail_type, count(DISTINCT user_id) AS ids,
  count(*) AS input_rows FROM d GROUP BY 1
UNION ALL SELECT strftime(date, '%Y-%m-%d'), 'arquivos', count(DISTINCT user_id), count(*) FROM d
WHERE event_type <> 'click' GROUP BY 1""")
def two_detail_types(t: Tables):
    """Items and documents of one source under one run name: tables, states and logs stay apart."""
    base, lake = fresh_path(t.spark, "lake"), None
    for kind, rows in (("itens", t.events), ("arquivos", t.events.where("event_type <> 'click'"))):
        job = Ingest(t.spark, base, "details", "user_id", "ts", ("event_id",), detail_type=kind)
        ingest_batch(job, rows, "daily")
        table = job.read().groupBy(partition_date().cast("string").alias("date")).agg(
            F.count("*").alias("ids")).withColumn("detail_type", F.lit(kind))
        lake = table if lake is None else lake.unionByName(table)
    return lake.join(job.state.runs().select("date", "detail_type", "input_rows"), ["date", "detail_type"], "full")


@query("T2 I2 I3", f"""
WITH e AS (SELECT *, event_id % 7 = 0 AS gone FROM events)
SELECT CASE WHEN gone THEN 'undated' ELSE strftime({LOCAL_DAY_SQL}, '%Y-%m-%d') END AS date,
  count(*) AS input_rows, count(DISTINCT user_id) AS new_rows, count(*) FILTER (gone) AS undated_rows,
  count(DISTINCT user_id) AS stored FROM e GROUP BY 1""")
def undated_records(t: Tables):
    """Records without a time are stored, remembered and logged on their own; a second run finds nothing new."""
    job = _event_job(t)
    some = t.events.withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    ingest_batch(job, some, "one")
    ingest_batch(job, some, "two")
    stored = job.read().groupBy(
        F.coalesce(partition_date().cast("string"), F.lit("undated")).alias("date")).agg(F.count("*").alias("stored"))
    runs = job.state.runs().where("run = 'one'").select("date", "input_rows", "new_rows", "undated_rows")
    return runs.join(stored, "date", "full")


class _Watched(StateTable):
    """A state table that looks at the lake from outside before it writes: data are there, ids are not."""

    seen: list = []

    def add(self, *args, **options):
        path = fresh_path(self.spark, "seen")
        job = self.job
        state = StateTable(job.spark, f"{job.base}/state", job.commits)
        job.read().select(F.lit("data").alias("part"), partition_date().alias("date"), "user_id").unionByName(
            state.ids("events").select(F.lit("state").alias("part"), F.col("date").cast("date").alias("date"),
                                       F.col("id").cast("long").alias("user_id"))).write.parquet(path)
        self.seen.append(path)
        super().add(*args, **options)


class _WatchedJob(Ingest):
    @property
    def state(self):
        watched = _Watched(self.spark, f"{self.base}/state", self.commits)
        watched.job = self
        return watched


@query("T1 I4", f"""
WITH first AS (SELECT DISTINCT {LOCAL_DAY_SQL} AS date, user_id FROM events WHERE event_type = 'click'),
  whole AS (SELECT DISTINCT {LOCAL_DAY_SQL} AS date, user_id FROM events)
SELECT 'between writes' AS moment, part, date, user_id FROM first, (SELECT unnest(['data', 'state']) AS part)
UNION ALL SELECT 'published', part, date, user_id FROM whole, (SELECT unnest(['data', 'state']) AS part)""")
def whole_runs_only(t: Tables):
    """A reader between the data and the state write of a second run sees the first run, then both."""
    job = _event_job(t)
    ingest_batch(job, t.events.where("event_type = 'click'"), "first")
    watched = _WatchedJob(job.spark, job.base, job.source, job.id_col, job.at, job.order)
    ingest_batch(watched, t.events, "second")
    between = t.spark.read.parquet(_Watched.seen.pop()).withColumn("moment", F.lit("between writes"))
    data = job.read().select(F.lit("data").alias("part"), partition_date().alias("date"), "user_id")
    state = job.state.ids("events").select(
        F.lit("state").alias("part"), F.col("date").cast("date").alias("date"), F.col("id").cast("long").alias("user_id"))
    return between.unionByName(data.unionByName(state).withColumn("moment", F.lit("published")))


@query("M1 T1", f"""
WITH d AS (SELECT DISTINCT {LOCAL_DAY_SQL} AS date, user_id FROM events),
  n AS (SELECT date, count(*) AS n FROM d GROUP BY 1)
SELECT moment, date, n AS rows, n AS ids FROM n, (SELECT unnest(['before', 'within', 'after', 'vacuumed']) AS moment)""")
def compaction_unseen(t: Tables):
    """Rows and distinct ids per day before a compaction, between its write and its swap, after it, and when old runs are gone."""
    job = _event_job(t)
    for kind in ("click", "purchase", "view"):
        ingest_batch(job, t.events.where(F.col("event_type") == kind), kind)
    ingest_batch(job, t.events, "rest")
    found = []

    def look(moment: str) -> None:
        path = fresh_path(t.spark, "seen")
        job.read().groupBy(partition_date().alias("date")).agg(
            F.count("*").alias("rows"), F.countDistinct("user_id").alias("ids")).withColumn("moment", F.lit(moment)).write.parquet(path)
        found.append(path)

    class Looking(CommitLog):
        def publish(self, *args, **options):
            look("within")
            return super().publish(*args, **options)

    look("before")
    compact(t.spark, f"{job.base}/{job.table}", "user_id", commits=Looking(t.spark, job.base))
    look("after")
    job.commits.fold()
    job.commits.vacuum(older_than_seconds=0)
    look("vacuumed")
    return t.spark.read.parquet(*found)


@query("T5 T1 I4", f"""
WITH d AS (SELECT {LOCAL_DAY_SQL} AS date, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1)
SELECT strftime(date, '%Y-%m-%d') AS date, 'hourly' AS kind, n AS input_rows, users AS new_rows FROM d
UNION ALL SELECT strftime(date, '%Y-%m-%d'), 'daily', n, 0 FROM d""")
def daily_reconcile(t: Tables):
    job = _stream_events(t, files_per_batch=2)
    ingest_batch(job, t.events, "daily")
    kind = F.when(F.col("run") == "daily", "daily").otherwise("hourly")
    return job.state.runs().groupBy("date", kind.alias("kind")).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("new_rows").alias("new_rows"))


@query("T3 N1", """
SELECT strftime(o_orderdate, '%Y-01-01') AS date, count(*) AS records, sum(coalesce(n, 0))::BIGINT AS itens
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
GROUP BY 1""")
def chunked_enrichment(t: Tables):
    landing = fresh_path(t.spark, "landing")
    # Noon, so that the local day is the same calendar day.
    at = F.date_trunc("year", "o_orderdate") + F.expr("INTERVAL 12 HOURS")
    t.orders.withColumn("at", at.cast("timestamp_ntz")).write.partitionBy("o_orderstatus").parquet(landing)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")

    def enrich(batch):
        # Only the children of this batch are grouped. Its ids may be sent to all executors, its lists are not.
        wanted = lines.join(batch.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        lists = nested.child_lists(wanted, ["l_orderkey"], ["l_linenumber", "l_extendedprice"], "itens").hint("merge")
        return batch.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")

    job = Ingest(
        t.spark, fresh_path(t.spark, "lake"), "details", "o_orderkey", "at", ("o_orderkey",),
        detail_type="itens", transform=enrich)
    stream = landing_stream(t.spark, landing, t.spark.read.parquet(landing).schema, files_per_batch=2)
    run_stream(job, stream, fresh_path(t.spark, "checkpoint"))
    return job.read().groupBy(partition_date().cast("string").alias("date")).agg(
        F.count("*").alias("records"), F.sum(nested.list_size("itens")).alias("itens"))


def _fed(t: Tables, name: str, base, known, stretches: int = 4) -> CarriedHistory:
    """Rows fed in stretches of days one after the other, state folded on the way."""
    table = CarriedHistory(t.spark, fresh_path(t.spark, "lake"), name, fold_every=3)
    span = base.agg(F.min("d").alias("low"), F.max("d").alias("high")).first()
    days = (span["high"] - span["low"]).days + 1
    after = span["low"] - timedelta(days=1)
    for i in range(1, stretches + 1):
        upto = span["low"] + timedelta(days=days * i // stretches - 1)
        table.feed(f"to-{upto}", base.where((F.col("d") > F.lit(after)) & (F.col("d") <= F.lit(upto))), "d", known, upto)
        after = upto
    return table


@query("B12 B27", REGISTRY["company_history"].sql)
def carried_company_history(t: Tables):
    """The company history of one run over all days, from four runs that read their own days and the state."""
    fed = _fed(t, "company_history", silver.contracts(t), lambda batch, totals: history.company_history(
        batch, "o_custkey", "d", "o_orderkey", F.col("v"), F.col("won"), "fim", totals))
    return fed.read().select(
        "o_orderkey", "previous_count", F.col("previous_value").cast("double").alias("previous_value"), "win_rate",
        F.col("days_since_previous").cast("long").alias("days_since_previous"),
        F.round("age_years", 6).alias("age_years"), "active_contracts")


@query("B13", REGISTRY["buyer_history"].sql)
def carried_buyer_history(t: Tables):
    fed = _fed(t, "buyer_history", silver.contracts(t), lambda batch, totals: history.buyer_history(
        batch, "c_nationkey", ["d", "o_orderkey"], "d", F.col("v"), F.col("score") > 0.8, totals))
    return fed.read().select("o_orderkey", "buyer_previous_count", "buyer_mean_value", "buyer_suspicion_rate")


@query("B28", REGISTRY["target_encoding"].sql)
def carried_target_encoding(t: Tables):
    base = silver.contracts(t).withColumn("group", F.concat_ws("|", F.col("c_nationkey").cast("string"), "cat"))
    label, parts = (F.col("score") > 0.8).cast("int"), range_bucket(F.col("o_orderkey"), 1 << 20)
    fed = _fed(t, "target_encoding", base, lambda batch, totals: history.target_encoding(
        batch, "group", ["d", "o_orderkey"], "d", label, "encoded", parts, totals))
    return fed.read().select("o_orderkey", "encoded")


def _stored(t: Tables) -> tuple[StoredChildren, StoredChildren]:
    """Items in two goes, every other line of a record in each, and attachments in one."""
    lines, files = items(t), attachments(t)
    buckets = buckets_for(t.spark, input_bytes(t.lineitem) + input_bytes(t.documents))
    stored = StoredChildren(t.spark, fresh_path(t.spark, "itens"), lines.schema, KEYS, ["numeroItem", "partkey"], buckets)
    for odd in (0, 1):
        stored.append(lines.where(F.col("numeroItem") % 2 == odd))
    documents = StoredChildren(t.spark, fresh_path(t.spark, "arquivos"), files.schema, KEYS, ["ordem"], buckets)
    return stored, documents.append(files)


@query("N1 N2 N3", REGISTRY["enriched_records"].sql)
def stored_enrichment(t: Tables):
    """Enrichment from children that lie in buckets of their parent's key."""
    return reporting.told(enrich_from_stored(records(t), *_stored(t), reporting.failed_reads(t)))
