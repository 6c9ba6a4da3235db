"""Queries: landed pages, layer writes and reads, registry dumps, compaction.

Each plan writes what it needs below the shared folder and reads it back, so the query covers
writer and reader on all rows of its table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators import maintain, sinks
from garimpo.operators.dedupe import dedupe_files
from garimpo.operators.nested import list_size
from garimpo.operators.reports import coverage, file_count
from garimpo.operators.state import StateTable
from garimpo.plans.registry import Tables, query
from garimpo.plans.shapes import money_sum
from garimpo.session import fresh_path
from garimpo.sources import drifting, lake, pages, registry_files

LOCAL_SQL = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Sao_Paulo')"

# ---- landed pages ---------------------------------------------------------------------------

PAGE_SIZE = 50
EVENT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
])
PULL_KEYS = T.StructType([T.StructField("day", T.DateType()), T.StructField("pagina", T.LongType())])

PAGES_SQL = """
ev AS (SELECT *, ts::DATE AS day, (event_id - min(event_id) OVER (PARTITION BY ts::DATE)) // 50 + 1 AS pagina FROM events),
pg AS (SELECT day, pagina, max(pagina) OVER (PARTITION BY day) - pagina AS remaining FROM ev GROUP BY day, pagina),
st AS (SELECT day, min(pagina) AS stop FROM pg
  WHERE remaining = 0 OR (pagina = 4 AND day(day) % 2 = 1) OR (pagina = 3 AND day(day) % 5 = 0) GROUP BY day),
reached AS (SELECT ev.* FROM ev JOIN st USING (day)
  WHERE pagina <= stop AND NOT (pagina = 3 AND day(day) % 5 = 0))
"""


def _landed_pages(t: Tables) -> str:
    """Events of a day as pages of 50, the odd page empty or without its count of remaining pages."""
    ev = t.events.withColumn("day", F.to_date("ts"))
    first = ev.groupBy("day").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    paged = ev.join(first, "day").withColumn(
        "pagina", F.floor((F.col("event_id") - F.col("first")) / PAGE_SIZE) + 1
    ).withColumn("pages", F.floor((F.col("last") - F.col("first")) / PAGE_SIZE) + 1)
    # A page holds at most 50 rows by construction.
    docs = paged.groupBy("day", "pagina", "pages").agg(
        F.sort_array(F.collect_list(F.struct(*EVENT.names))).alias("data"))
    dom = F.dayofmonth("day")
    docs = docs.select(
        "day", "pagina",
        F.when((F.col("pagina") == 3) & (dom % 5 == 0), F.expr("filter(data, x -> false)")).otherwise(F.col("data")).alias("data"),
        F.when((F.col("pagina") == 4) & (dom % 2 == 1), F.lit(None)).otherwise(F.col("pages") - F.col("pagina"))
        .alias("paginasRestantes"),
    )
    path = fresh_path(t.spark, "pages")
    docs.write.json(path)
    return path


@query("S1 S2", f"WITH {PAGES_SQL} SELECT day, pagina, event_id, user_id, event_type, value FROM reached")
def assembled_pages(t: Tables):
    landed = pages.read_pages(t.spark, _landed_pages(t), EVENT, PULL_KEYS, multi_line=False)
    kept = pages.reachable_pages(landed, ["day"], "pagina", pages.is_last_page())
    return pages.page_rows(kept, ["day", "pagina"]).drop("pos")


@query("S5 S2 S1", f"""WITH {PAGES_SQL} SELECT day, count(*) AS records FROM reached
WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND pagina <= 2 GROUP BY day""")
def limited_pull(t: Tables):
    landed = pages.read_pages(t.spark, _landed_pages(t), EVENT, PULL_KEYS, multi_line=False)
    window = pages.pull_window("custom", date(2024, 1, 31), date(2024, 1, 5), date(2024, 1, 12), max_pages=2)
    kept = pages.pull(landed, ["day"], "pagina", "day", window)
    return pages.page_rows(kept, ["day"]).groupBy("day").agg(F.count("*").alias("records"))


@query("S9", f"""WITH {PAGES_SQL} SELECT event_id, value FROM ev WHERE NOT (pagina = 3 AND day(day) % 5 = 0)""")
def wrapped_record_files(t: Tables):
    return lake.read_records_json(t.spark, _landed_pages(t), multi_line=False).select("event_id", "value")


@query("S3", """
WITH l AS (SELECT *, (row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 2 + 1 AS pagina FROM lineitem),
k AS (SELECT l_orderkey, pagina, count(*) FILTER (l_returnflag <> 'A' OR pagina > 1) AS n FROM l GROUP BY ALL),
s AS (SELECT l_orderkey, min(pagina) AS stop FROM k WHERE n < 2 GROUP BY 1)
SELECT l_orderkey, count(*) AS items, max(pagina) AS pages FROM l LEFT JOIN s USING (l_orderkey)
WHERE (l_returnflag <> 'A' OR pagina > 1) AND pagina <= coalesce(stop, pagina) GROUP BY 1""")
def child_pages_until_short(t: Tables):
    # Two items make a full page here; page one loses its "A" lines and may end the sequence.
    by_line = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    placed = t.lineitem.withColumn("pagina", F.floor((F.row_number().over(by_line) - 1) / 2) + 1)
    entry = F.when((F.col("l_returnflag") != "A") | (F.col("pagina") > 1), F.struct("l_linenumber", "l_partkey"))
    docs = placed.groupBy("l_orderkey", "pagina").agg(F.collect_list(entry).alias("data"))
    landing = fresh_path(t.spark, "child-pages")
    # A document per line, bare lists and wrapped ones; the keys are part of it.
    wrapped = F.when(F.col("l_orderkey") % 2 == 0, F.to_json(F.struct("data"))).otherwise(F.to_json("data"))
    docs.select("l_orderkey", "pagina", wrapped.alias("body")).write.json(landing)
    entry = T.StructType([T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_partkey", T.LongType())])
    keys = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("pagina", T.LongType())])
    landed = pages.read_child_pages(t.spark, landing, entry, keys, whole_file=False)
    kept = pages.reachable_pages(landed, ["l_orderkey"], "pagina", pages.is_short_page(full=2))
    rows = pages.page_rows(kept, ["l_orderkey", "pagina"])
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("items"), F.max("pagina").alias("pages"))


# ---- layers ---------------------------------------------------------------------------------

TWO_RUNS_SQL = """
two AS (SELECT *, 'a' AS run FROM events WHERE event_type <> 'purchase'
  UNION ALL SELECT *, 'b' FROM events WHERE event_type <> 'click')"""


def _two_runs(t: Tables, undated: bool = False) -> str:
    """Events written by two runs that overlap; with ``undated`` every event comes without a time as well."""
    base = fresh_path(t.spark, "bronze")
    events = t.events
    if undated:
        gone = events.withColumns({"event_id": -1 - F.col("event_id"), "ts": F.lit(None).cast("timestamp_ntz")})
        events = events.unionByName(gone)
    sinks.write_bronze(events.where("event_type <> 'purchase'"), base, "events", F.col("ts"), "a")
    return sinks.write_bronze(events.where("event_type <> 'click'"), base, "events", F.col("ts"), "b")


@query("K1 S7 S8 D2", f"""WITH {TWO_RUNS_SQL}
SELECT event_id, min(run) AS run, strftime({LOCAL_SQL}, '%Y') AS year, strftime({LOCAL_SQL}, '%m') AS month,
  strftime({LOCAL_SQL}, '%d') AS day FROM two
WHERE {LOCAL_SQL}::DATE BETWEEN DATE '2023-12-31' AND DATE '2024-01-20' GROUP BY event_id, ts""")
def bronze_range(t: Tables):
    path = _two_runs(t, undated=True)
    found = lake.read_days(t.spark, path, date(2023, 12, 31), date(2024, 1, 20))
    return dedupe_files(found, "event_id").select("event_id", "run", "year", "month", "day")


@query("S6 S10", f"""WITH {TWO_RUNS_SQL}
SELECT event_id, user_id, value, min(run) AS run FROM two WHERE {LOCAL_SQL}::DATE = DATE '2024-01-15' GROUP BY ALL""")
def bronze_day(t: Tables):
    schema = "event_id long, user_id long, value double, year string, month string, day string, run string"
    one = lake.read_day(t.spark, _two_runs(t, undated=True), date(2024, 1, 15), "event_id", schema)
    return one.select("event_id", "user_id", "value", "run")


@query("K1 S10", f"""
SELECT {LOCAL_SQL}::DATE AS day, event_type, count(*) AS records, sum(value::DECIMAL(15,2))::DOUBLE AS total
FROM events GROUP BY ALL""")
def bronze_json(t: Tables):
    events = t.events.select("event_id", "event_type", "value", "ts")
    path = sinks.write_bronze(events, fresh_path(t.spark, "bronze"), "events", F.col("ts"), "a", fmt="json")
    back = t.spark.read.schema(
        "event_id long, event_type string, value double, year string, month string, day string").json(path)
    return back.groupBy(lake.partition_date().alias("day"), "event_type").agg(
        F.count("*").alias("records"), money_sum("value").alias("total"))


@query("K2 S10", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'""")
def silver_partition(t: Tables):
    silver = t.orders.withColumn("ano", F.year("o_orderdate").cast("string"))
    path = sinks.write_silver(silver, fresh_path(t.spark, "silver"), "orders", ["ano", "o_orderstatus"])
    found = lake.read_table(t.spark, path).where("ano = '1997' and o_orderstatus = 'F'")
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query("K3 S10", "SELECT p_partkey, ln(p_retailprice) > 6.85 AS expensive FROM part")
def gold_features(t: Tables):
    features = t.part.select("p_partkey", (F.log("p_retailprice") > 6.85).alias("expensive"))
    path = sinks.write_gold(features, fresh_path(t.spark, "gold"), "part_features")
    return lake.read_table(t.spark, path)


@query("K7", """SELECT year(o_orderdate)::VARCHAR AS ano, count(*) AS record_count, 'silver' AS layer,
'o_orderkey,o_totalprice,ano' AS columns, 3 AS feature_count FROM orders GROUP BY 1""")
def write_metadata(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("ano"))
    path = sinks.write_silver(rows, fresh_path(t.spark, "silver"), "orders", ["ano"])
    return sinks.write_metadata(lake.read_table(t.spark, path), "silver", ["ano"])


@query("K4", """SELECT o_orderstatus, count(*) AS records, sum(coalesce(n, 0))::BIGINT AS itens FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")
def details_chunks(t: Tables):
    lists = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(F.struct("l_linenumber", "l_extendedprice")).alias("itens"))
    nested = t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    at = F.date_trunc("year", "o_orderdate")
    path = sinks.write_bronze(
        nested, fresh_path(t.spark, "bronze"), "details", at, "chunk", max_records_per_file=1_000_000)
    return lake.read_table(t.spark, path).groupBy("o_orderstatus").agg(
        F.count("*").alias("records"), F.sum(list_size("itens")).alias("itens"))


@query("K8 B22", """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_totalprice > 250000""")
def csv_export(t: Tables):
    wanted = t.orders.where("o_totalprice > 250000").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = sinks.export_csv(wanted, fresh_path(t.spark, "export"))
    return t.spark.read.schema(wanted.schema).option("header", True).option("escape", '"').csv(path)


@query("K9", """SELECT source, lang, count(*) AS n, 'licitação ' || lang AS label FROM documents GROUP BY ALL""")
def json_export(t: Tables):
    report = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n")).withColumn(
        "label", F.concat(F.lit("licitação "), "lang"))
    path = sinks.export_json(report, fresh_path(t.spark, "export"))
    return t.spark.read.schema(report.schema).json(path)


@query("S14", f"""WITH {TWO_RUNS_SQL}
SELECT strftime({LOCAL_SQL}, 'year=%Y/month=%m/day=%d') AS folder, count(DISTINCT run) AS runs, true AS filled
FROM two GROUP BY 1""")
def file_inventory(t: Tables):
    files = lake.inventory(t.spark, _two_runs(t), "*.parquet")
    folder = F.regexp_extract("path", r"(year=\d{4}/month=\d{2}/day=\d{2})/run=(\w+)", 1)
    run = F.regexp_extract("path", r"/run=(\w+)", 1)
    return files.groupBy(folder.alias("folder")).agg(
        F.countDistinct(run).alias("runs"), F.min(F.col("length") > 0).alias("filled"))


# ---- registry -------------------------------------------------------------------------------

# The registry publishes companies in ten files and each code list in one, whatever their size.
COMPANY_FILES = 10


def _csv(df: DataFrame, path: str, parts: int) -> str:
    writer = df.repartition(parts).write.option("sep", ";").option("encoding", "ISO-8859-1")
    writer.option("quote", '"').option("escape", '"').option("quoteAll", True).option("emptyValue", "").csv(path)
    return path


def _companies(t: Tables) -> DataFrame:
    name = F.when(F.col("c_mktsegment") == "BUILDING", "NULL").when(F.col("c_mktsegment") == "MACHINERY", "")
    odd = F.concat(F.lit('Construções; "'), F.col("c_mktsegment"), F.lit('" \\'))
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"), name.otherwise(odd).alias("c"))


@query("S11 K6", """
SELECT c_custkey::VARCHAR AS col_0, c_name AS col_1, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
  THEN 'Construções; "' || c_mktsegment || '" \\' END AS col_2, '2025-10' AS version FROM customer""")
def registry_snapshot(t: Tables):
    path = _csv(_companies(t), fresh_path(t.spark, "dump"), COMPANY_FILES)
    rows = registry_files.read_registry(t.spark, path, "empresas")
    table = sinks.write_registry(rows, fresh_path(t.spark, "registry"), "empresas", "2025-10")
    return lake.read_table(t.spark, table)


@query("S11 S12 S13 A12", """
WITH n(entity, total_files, successes, total_rows) AS (
  SELECT 'empresas', 10, 10, count(*) FROM customer UNION ALL SELECT 'cnaes', 1, 1, count(*) FROM nation
  UNION ALL SELECT * FROM (VALUES ('estabelecimentos', 10, 0, 0), ('socios', 10, 0, 0), ('simples', 1, 0, 0),
    ('municipios', 1, 0, 0), ('naturezas', 1, 0, 0), ('qualificacoes', 1, 0, 0), ('paises', 1, 0, 0), ('motivos', 1, 0, 0)))
SELECT entity, total_files::BIGINT AS total_files, successes::BIGINT AS successes, total_rows::BIGINT AS total_rows,
  (total_files - successes)::BIGINT AS failures FROM n
UNION ALL SELECT 'TOTAL', sum(total_files)::BIGINT, sum(successes)::BIGINT, sum(total_rows)::BIGINT,
  sum(total_files - successes)::BIGINT FROM n""")
def registry_ingest_totals(t: Tables):
    nations = t.nation.select(F.col("n_nationkey").cast("string"), "n_name")
    dumps = {"empresas": _csv(_companies(t), fresh_path(t.spark, "dump"), COMPANY_FILES),
             "cnaes": _csv(nations, fresh_path(t.spark, "dump"), 1)}
    per_file = None
    for entity, path in dumps.items():
        raw = t.spark.read.csv(path, sep=";", encoding="ISO-8859-1", quote='"', escape='"', multiLine=True)
        counted = registry_files.rows_per_file(raw).select(F.lit(entity).alias("entity"), "rows")
        per_file = counted if per_file is None else per_file.unionByName(counted)
    summary = registry_files.ingest_summary(per_file, registry_files.catalogue(t.spark))
    total = registry_files.ingest_totals(summary).withColumn("entity", F.lit("TOTAL"))
    return summary.unionByName(total)


@query("S15 S16", """
WITH v AS (SELECT (SELECT strftime(max(o_orderdate), '%Y-%m') FROM orders) AS current,
  (SELECT strftime(max(l_shipdate), '%Y-%m') FROM lineitem) AS latest)
SELECT current, latest, current <> latest AS needs_update FROM v""")
def registry_version_check(t: Tables):
    listing = t.lineitem.select(F.concat(
        F.lit('<a href="'), F.date_format("l_shipdate", "yyyy-MM"), F.lit('/">'), F.lit("2099-12 README</a>")).alias("html"))
    latest = registry_files.latest_version(listing, "html")
    current = t.orders.agg(F.max(F.date_format("o_orderdate", "yyyy-MM")))
    return registry_files.version_check(current, latest)


# ---- maintenance ----------------------------------------------------------------------------

@query("M2", f"""WITH {TWO_RUNS_SQL}
SELECT {LOCAL_SQL}::DATE AS date, count(*) AS total_before, count(DISTINCT event_id) AS total_after,
  count(*) - count(DISTINCT event_id) AS duplicates_removed, true AS needs_work FROM two GROUP BY 1""")
def compaction_preview(t: Tables):
    stats = maintain.compact(t.spark, _two_runs(t), "event_id", dry_run=True)
    return stats.select(
        lake.partition_date().alias("date"), "total_before", "total_after", "duplicates_removed", "needs_work")


@query("M1", f"""
SELECT {LOCAL_SQL}::DATE AS date, count(*) AS records, 1::BIGINT AS files, count(DISTINCT event_id) AS ids,
  sum(value::DECIMAL(15,2))::DOUBLE AS total FROM events GROUP BY 1""")
def compacted_days(t: Tables):
    path = _two_runs(t)
    maintain.compact(t.spark, path, "event_id")
    table = lake.read_table(t.spark, path).select("*", F.col("_metadata.file_path").alias("file"))
    return table.groupBy(lake.partition_date().alias("date")).agg(
        F.count("*").alias("records"), F.countDistinct("file").alias("files"),
        F.countDistinct("event_id").alias("ids"), money_sum("value").alias("total"))


@query("M1 M2", f"""WITH {TWO_RUNS_SQL}
SELECT {LOCAL_SQL}::DATE AS date, count(DISTINCT event_id) AS total_before, count(DISTINCT event_id) AS total_after,
  false AS needs_work FROM two GROUP BY 1 UNION ALL SELECT NULL, count(*), count(*), false FROM events""")
def second_compaction(t: Tables):
    """After a compaction nothing is left to do, rows without a day included."""
    path = _two_runs(t, undated=True)
    maintain.compact(t.spark, path, "event_id")
    stats = maintain.compact(t.spark, path, "event_id")
    return stats.select(lake.partition_date().alias("date"), "total_before", "total_after", "needs_work")


@query("M1 D2", f"""SELECT {LOCAL_SQL}::DATE AS date, event_type, count(DISTINCT user_id) AS records FROM events GROUP BY ALL""")
def compacted_without_id(t: Tables):
    """A table without an id column: identical rows collapse, within a run and across runs."""
    base, rows = fresh_path(t.spark, "bronze"), t.events.select("user_id", "event_type", "ts")
    day = F.date_trunc("day", F.convert_timezone(F.lit("UTC"), F.lit("America/Sao_Paulo"), "ts"))
    rows = rows.withColumn("ts", F.convert_timezone(F.lit("America/Sao_Paulo"), F.lit("UTC"), day.cast("timestamp_ntz")))
    for run, wanted in (("a", "event_type <> 'purchase'"), ("b", "event_type <> 'click'")):
        path = sinks.write_bronze(rows.where(wanted), base, "events", F.col("ts"), run)
    maintain.compact(t.spark, path, "event_id")
    return lake.read_table(t.spark, path).groupBy(lake.partition_date().alias("date"), "event_type").agg(
        F.count("*").alias("records"))


@query("A1 M1", f"""WITH d AS (SELECT {LOCAL_SQL}::DATE AS d, event_id FROM events)
SELECT CASE grouping(y, m) WHEN 3 THEN 'total' WHEN 1 THEN 'year' ELSE 'month' END AS grain, y AS year, m AS year_month,
  count(*) AS records, count(DISTINCT event_id) AS unique_ids, (SELECT count(DISTINCT d) FROM d) AS total_files
FROM (SELECT year(d)::INT AS y, strftime(d, '%Y-%m') AS m, event_id FROM d) GROUP BY GROUPING SETS ((), (y), (y, m))""")
def coverage_of_lake(t: Tables):
    """The coverage report of a compacted table, where every day is one file."""
    path = _two_runs(t)
    maintain.compact(t.spark, path, "event_id")
    table = lake.read_table(t.spark, path)
    report = coverage(table, lake.partition_date(), F.col("event_id"))
    return report.withColumn("total_files", file_count(table).scalar())


@query("M3", f"""WITH {TWO_RUNS_SQL}
SELECT 'data' AS kind, {LOCAL_SQL}::DATE AS date, count(*) AS records FROM two
WHERE {LOCAL_SQL}::DATE <> DATE '2024-01-15' GROUP BY 2
UNION ALL SELECT 'state', {LOCAL_SQL}::DATE, count(DISTINCT event_id) FROM events
WHERE {LOCAL_SQL}::DATE <> DATE '2024-01-15' GROUP BY 2""")
def cleaned_day(t: Tables):
    path = _two_runs(t)
    base = path.rsplit("/", 1)[0]
    state = StateTable(t.spark, f"{base}/state")
    day = F.convert_timezone(F.lit("UTC"), F.lit("America/Sao_Paulo"), "ts").cast("date").cast("string")
    state.add(t.events.select(F.col("event_id").cast("string").alias("id"), day.alias("date")), "events", "a")
    folders = maintain.day_folders(base, date(2024, 1, 15), ["events", "absent"], ["events"], ["records", "itens"])
    maintain.clean_day(t.spark, folders)
    data = lake.read_table(t.spark, path).groupBy(lake.partition_date().alias("date")).agg(F.count("*").alias("records"))
    ids = state.ids("events").groupBy(F.col("date").cast("date").alias("date")).agg(F.count("*").alias("records"))
    return data.select(F.lit("data").alias("kind"), "*").unionByName(ids.select(F.lit("state").alias("kind"), "*"))


# ---- records whose fields change type -------------------------------------------------------

DRIFT_FIELDS = [drifting.Field("event_id", "$.event_id", "long"), drifting.Field("value", "$.value", "double"),
                drifting.Field("amount", "$.value.amount", "double", texts=True)]


def _drifting_events(t: Tables) -> DataFrame:
    """Events as pages of one record each; ``value`` is a number, a text, absent, an object with a text, or null."""
    number, which = F.col("value").cast("string"), F.col("event_id") % 5
    value = (F.when(which == 0, F.concat(F.lit(',"value":'), number))
             .when(which == 1, F.concat(F.lit(',"value":"'), number, F.lit('"')))
             .when(which == 2, F.lit(""))
             .when(which == 3, F.concat(F.lit(',"value":{"amount":"'), number, F.lit('"}')))
             .otherwise(F.lit(',"value":null')))
    path = fresh_path(t.spark, "landing")
    t.events.select(F.concat(F.lit('{"data":[{"event_id":'), "event_id", value, F.lit("}]}"))).write.text(path)
    return drifting.page_records(drifting.read_records(t.spark, path))


DRIFT_SQL = "ev AS (SELECT event_id, event_id % 5 AS w, value AS v FROM events)"


@query("S1 S9 V1", f"""WITH {DRIFT_SQL}
SELECT event_id, CASE w WHEN 0 THEN v END AS value, CASE w WHEN 3 THEN v END AS amount,
  CASE w WHEN 1 THEN 'Wrong type in \'\'value\'\': expected double, found STRING'
    WHEN 3 THEN 'Wrong type in \'\'value\'\': expected double, found OBJECT' ELSE '' END AS errors FROM ev""".replace("\\'", "'"))
def drifting_records(t: Tables):
    """A field that changes type: values of the expected type, and an error for each other one."""
    read = drifting.typed(_drifting_events(t), DRIFT_FIELDS)
    return read.select("event_id", "value", "amount", F.array_join("type_errors", "; ").alias("errors"))


@query("S1 V1", f"""WITH {DRIFT_SQL},
k AS (SELECT 'event_id' AS field, 'BIGINT' AS kind FROM ev
  UNION ALL SELECT 'value', CASE w WHEN 0 THEN 'NUMBER' WHEN 1 THEN 'STRING' WHEN 2 THEN 'ABSENT' WHEN 3 THEN 'OBJECT' ELSE 'NULL' END FROM ev
  UNION ALL SELECT 'amount', CASE w WHEN 3 THEN 'STRING' ELSE 'ABSENT' END FROM ev)
SELECT field, kind, count(*) AS records FROM k GROUP BY ALL""")
def drift_report(t: Tables):
    """Kinds found per field; the ways to write a fraction count as one."""
    found = drifting.kinds_found(_drifting_events(t), DRIFT_FIELDS)
    number = F.when(F.col("kind").isin("DECIMAL", "DOUBLE") | ((F.col("field") == "value") & (F.col("kind") == "BIGINT")), "NUMBER")
    return found.groupBy("field", F.coalesce(number, "kind").alias("kind")).agg(F.sum("records").alias("records"))
