"""Queries: record predicates, dates, deduplication, state filters, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.functions.cleaning import sanitize_frame
from garimpo.functions.domains import count_by_modalidade, keep_modalidades, modalidade_subset
from garimpo.functions import timeparts
from garimpo.operators import dedupe, filters, validate
from garimpo.operators.running import position
from garimpo.plans.registry import Tables, query
from garimpo.plans.shapes import NOTICES_SQL, NOTICE_TIME_SQL, notices, returned_orders, shipped_orders

@query("F1", f"""WITH {NOTICES_SQL}
SELECT doc_id, "numeroControlePNCP" FROM notices WHERE "numeroControlePNCP" <> ''""")
def required_id_filter(t: Tables):
    return filters.with_id(notices(t), "numeroControlePNCP").select("doc_id", "numeroControlePNCP")


@query("F2", f"""WITH {NOTICES_SQL}
SELECT doc_id, nullif("numeroControlePNCP", '') AS record_key FROM notices""")
def record_key(t: Tables):
    return notices(t).select("doc_id", filters.record_key(F.col("numeroControlePNCP")).alias("record_key"))


@query("F3", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1997-03-01'""")
def date_range_inclusive(t: Tables):
    chosen = filters.date_range(t.orders, "1996-03-01", "1997-02-28", "o_orderdate")
    return chosen.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))


@query("F3 V2", f"""WITH {NOTICES_SQL}, parsed AS (SELECT doc_id, {NOTICE_TIME_SQL} AS utc FROM notices)
SELECT doc_id FROM parsed WHERE utc >= DATE '2024-10-05' AND utc < DATE '2024-10-23'""")
def date_range_of_texts(t: Tables):
    return filters.date_range(notices(t), "2024-10-05", "2024-10-22", "dataPublicacaoPncp").select("doc_id")


@query("V2 F3", f"""WITH {NOTICES_SQL}
SELECT doc_id, strftime({NOTICE_TIME_SQL}, '%Y-%m-%d %H:%M:%S') AS published_utc FROM notices""")
def iso_dates(t: Tables):
    at = timeparts.iso_timestamp(F.col("dataPublicacaoPncp"))
    return notices(t).select("doc_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("published_utc"))


@query("F4", """
WITH env(env, code) AS (VALUES ('development', 4), ('development', 6), ('development', 8),
  ('staging', 1), ('staging', 4), ('staging', 6)),
pairs AS (SELECT env, p_size FROM part JOIN env ON code = p_size
  UNION ALL SELECT 'production', p_size FROM part)
SELECT env, p_size AS code, count(*) AS records FROM pairs GROUP BY ALL""")
def category_subsets(t: Tables):
    out = None
    for env in ("development", "staging", "production"):
        kept = keep_modalidades(t.part, "p_size", modalidade_subset(env))
        counts = kept.groupBy(F.lit(env).alias("env"), F.col("p_size").alias("code")).agg(
            F.count("*").alias("records"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query("S4 A11", """
SELECT code, coalesce(n, 0) AS records FROM range(1, 14) r(code)
LEFT JOIN (SELECT p_size, count(*) AS n FROM part GROUP BY p_size) ON p_size = code""")
def records_by_category(t: Tables):
    counts = count_by_modalidade(t.part, "p_size")
    return counts.select(F.col("code").cast("long").alias("code"), "records")


@query("F6", """SELECT o_orderkey, 'orders' AS meta_source, 3 AS meta_layers,
'["bronze", "silver"]' AS meta_targets, '2025-10-23T02:00:00' AS meta_started, true AS stamped FROM orders""")
def run_metadata(t: Tables):
    from datetime import datetime

    stamped = filters.add_metadata(t.orders.select("o_orderkey"), {
        "source": "orders", "layers": 3, "targets": ["bronze", "silver"],
        "started": datetime(2025, 10, 23, 2),
    })
    return stamped.withColumn("stamped", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


@query("F9", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_second,
  CASE WHEN event_type <> 'error' THEN value END AS nested_value,
  CAST(event_type <> 'error' AS INT) AS list_values
FROM events""")
def sanitized_values(t: Tables):
    raw = t.events.select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "ts",
    )
    raw = raw.select("*", F.struct("value", F.array("value").alias("all")).alias("inner"))
    clean = sanitize_frame(raw)
    return clean.select(
        "event_id", "value", F.substring("ts", 1, 19).alias("ts_second"),
        F.col("inner.value").alias("nested_value"),
        F.size(F.array_compact("inner.all")).alias("list_values"),
    )


@query("D1", """
SELECT user_id, event_id, event_type FROM events
WHERE user_id NOT IN (SELECT conv_id FROM conversations WHERE turn > 3)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def dedupe_with_memory(t: Tables):
    seen = t.conversations.where("turn > 3").select(F.col("conv_id").cast("string"))
    events = t.events.withColumn("uid", F.col("user_id").cast("string"))
    return dedupe.dedupe_batch(events, "uid", ["event_id"], seen).select("user_id", "event_id", "event_type")


@query("D1 D2", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1""")
def keep_first_line(t: Tables):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    first = dedupe.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("D3 I5", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')""")
def new_records(t: Tables):
    fresh = dedupe.new_records(t.orders, F.col("o_orderkey"), returned_orders(t))
    return fresh.select("o_orderkey", "o_custkey")


@query("D3", f"""WITH {NOTICES_SQL},
done AS (SELECT DISTINCT 'DOC-' || l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'),
s AS (SELECT lang, count(*) AS total_input,
  count(CASE WHEN "numeroControlePNCP" <> '' AND id IS NULL THEN 1 END) AS new_records,
  count(CASE WHEN coalesce("numeroControlePNCP", '') = '' THEN 1 END) AS missing_id
  FROM notices LEFT JOIN done ON id = "numeroControlePNCP" GROUP BY lang)
SELECT lang, total_input, total_input - new_records AS already_processed, new_records, missing_id,
  round((total_input - new_records) / total_input * 100, 2) AS filter_rate FROM s""")
def new_record_stats(t: Tables):
    done = returned_orders(t).select(F.concat(F.lit("DOC-"), F.col("id").cast("string")).alias("id"))
    key = F.col("numeroControlePNCP")
    return dedupe.filter_stats(dedupe.flag_new(notices(t), key, done, "is_new"), "is_new", key, ["lang"])


@query("D4", """
SELECT 'itens' AS detail_type, o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL
SELECT 'arquivos', o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""")
def new_details(t: Tables):
    def of(kind, done):
        fresh = dedupe.new_records(t.orders, F.col("o_orderkey"), done)
        return fresh.select(F.lit(kind).alias("detail_type"), "o_orderkey")

    return of("itens", returned_orders(t)).unionByName(of("arquivos", shipped_orders(t)))


@query("D5", """
WITH f AS (SELECT o_orderkey,
  o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS needs_items,
  o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AS needs_documents FROM orders)
SELECT * FROM f WHERE needs_items OR needs_documents""")
def needs_details(t: Tables):
    wanted = dedupe.needs_details(t.orders, F.col("o_orderkey"), returned_orders(t), shipped_orders(t))
    return wanted.select("o_orderkey", "needs_items", "needs_documents")


@query("D6 F7", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def resume_batch(t: Tables):
    batch = dedupe.resume_batch(
        t.orders, F.col("o_orderkey"), returned_orders(t), ["o_orderdate", "o_orderkey"], batch_size=100)
    return batch.select("o_orderkey", "o_custkey")


@query("F7", """
WITH a AS (SELECT count(*) AS available FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'))
SELECT available, least(available, 100) AS processed, greatest(available - 100, 0) AS remaining FROM a""")
def batch_progress(t: Tables):
    rest = dedupe.new_records(t.orders, F.col("o_orderkey"), returned_orders(t))
    return filters.batch_progress(rest, filters.take_batch(rest, ["o_orderdate", "o_orderkey"], 100, None))


VALID_SQL = f"""coalesce("numeroControlePNCP", '') <> '' AS id_ok,
  coalesce("dataPublicacaoPncp", '') = '' OR ({NOTICE_TIME_SQL}) IS NOT NULL AS date_ok"""


@query("V1 V2", f"""WITH {NOTICES_SQL}, v AS (SELECT doc_id, {VALID_SQL} FROM notices)
SELECT doc_id, CAST(NOT id_ok AS INT) + CAST(NOT date_ok AS INT) AS n_errors FROM v""")
def validated_records(t: Tables):
    return validate.with_errors(notices(t)).select("doc_id", F.size("errors").alias("n_errors"))


@query("V3", f"""WITH {NOTICES_SQL}, v AS (SELECT doc_id, {VALID_SQL} FROM notices)
SELECT count(*) AS total_records, count(*) FILTER (id_ok AND date_ok) AS valid_records,
  count(*) FILTER (NOT (id_ok AND date_ok)) AS invalid_records FROM v""")
def validation_report(t: Tables):
    return validate.validation_report(validate.with_errors(notices(t)))


@query("V3", f"""WITH {NOTICES_SQL}, v AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, {VALID_SQL} FROM notices),
m AS (SELECT idx, 0 AS part, 'Missing required field ''numeroControlePNCP''' AS e FROM v WHERE NOT id_ok
  UNION ALL SELECT idx, 1, 'Invalid date format in ''dataPublicacaoPncp''' FROM v WHERE NOT date_ok)
SELECT idx, 'Record ' || idx || ': ' || e AS message FROM m ORDER BY idx, part LIMIT 10""")
def validation_messages(t: Tables):
    placed = position(validate.with_errors(notices(t)), "doc_id", "idx")
    return validate.first_messages(placed, "idx").select("idx", "message")


GATE_INPUT_SQL = """
m AS (SELECT o_orderdate, count(*) AS total_input,
  count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS new_records,
  count(*) FILTER (o_totalprice > 480000
    AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS invalid_records
  FROM orders GROUP BY o_orderdate)"""


def _daily_metrics(t: Tables):
    """Per order day what an ingestion run would report; expensive orders play the invalid ones."""
    flagged = dedupe.flag_new(t.orders, F.col("o_orderkey"), returned_orders(t), "is_new")
    new = F.sum(F.col("is_new").cast("long"))
    bad = F.col("is_new") & (F.col("o_totalprice") > 480000)
    return flagged.groupBy("o_orderdate").agg(
        F.count("*").alias("total_input"), new.alias("new_records"), new.alias("record_count"),
        F.sum(bad.cast("long")).alias("invalid_records"),
    ).withColumns({
        "uploaded": F.col("record_count") > 0,
        "key": F.concat(F.lit("orders/"), F.date_format("o_orderdate", "yyyyMMdd")),
    })


@query("V4", f"""WITH {GATE_INPUT_SQL}
SELECT CAST(o_orderdate AS DATE) AS day, new_records = 0 OR invalid_records = 0 AS validated,
  new_records = 0 AS no_data, CASE WHEN new_records = 0 THEN 'all_duplicates' END AS reason FROM m""")
def ingestion_gate(t: Tables):
    gate = validate.ingestion_gate(_daily_metrics(t))
    return gate.select(F.to_date("o_orderdate").alias("day"), "validated", "no_data", "reason")


@query("V5", f"""WITH {GATE_INPUT_SQL}, r AS (SELECT o_orderdate, new_records > 0 AS has_data,
  CASE WHEN new_records > 0 THEN NULL WHEN total_input > 2 THEN 'all_processed' ELSE 'timeout' END AS reason FROM m)
SELECT CAST(o_orderdate AS DATE) AS day, has_data OR reason = 'all_processed' AS validated FROM r""")
def details_gate(t: Tables):
    metrics = _daily_metrics(t).select(
        "o_orderdate", (F.col("new_records") > 0).alias("has_data"),
        F.when(F.col("new_records") > 0, F.lit(None)).when(F.col("total_input") > 2, "all_processed")
        .otherwise("timeout").alias("reason"),
    )
    return validate.details_gate(metrics).select(F.to_date("o_orderdate").alias("day"), "validated")


LOCAL_SQL = "ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Sao_Paulo'"


@query("T-1 T-2 T-3", f"""
SELECT event_id, strftime({LOCAL_SQL}, '%Y-%m-%d %H:%M:%S') AS local_time, strftime({LOCAL_SQL}, '%Y%m%d') AS day_key,
  strftime({LOCAL_SQL}, '%Y%m%d_%H%M%S') AS run_stamp, strftime({LOCAL_SQL}, '%Y') AS year,
  strftime({LOCAL_SQL}, '%m') AS month, strftime({LOCAL_SQL}, '%d') AS day FROM events""")
def local_business_day(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id", F.date_format(timeparts.to_local(ts), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        timeparts.day_key(ts).alias("day_key"), timeparts.run_stamp(ts).alias("run_stamp"),
        *(c.alias(n) for n, c in timeparts.partition_parts(ts).items()),
    )


@query("T-4", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP) AT TIME ZONE 'America/Sao_Paulo' AT TIME ZONE 'UTC',
  '%Y-%m-%d %H:%M:%S') AS midnight_utc FROM orders""")
def local_midnight(t: Tables):
    key = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select(
        "o_orderkey", F.date_format(timeparts.parse_day_key(key), "yyyy-MM-dd HH:mm:ss").alias("midnight_utc"))


@query("T-5 S7", """
WITH bounds AS (SELECT min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS b FROM lineitem),
days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM bounds),
n AS (SELECT l_shipdate::DATE AS day, count(*) AS records FROM lineitem GROUP BY 1)
SELECT day, coalesce(records, 0) AS records FROM days LEFT JOIN n USING (day)""")
def records_per_calendar_day(t: Tables):
    daily = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("records"))
    return timeparts.fill_missing_days(daily, "day", F.min("day"), F.max("day"), ["records"])


@query("T-5", """
WITH last AS (SELECT max(ts)::DATE AS d FROM events)
SELECT ts::DATE AS day, count(*) AS records FROM events, last
WHERE ts::DATE BETWEEN d - 7 AND d GROUP BY 1""")
def last_seven_days(t: Tables):
    newest = t.events.agg(F.to_date(F.max("ts"))).scalar()
    first, last = timeparts.last_days(newest, 7)
    day = F.to_date("ts")
    return t.events.where(day.between(first, last)).groupBy(day.alias("day")).agg(F.count("*").alias("records"))
