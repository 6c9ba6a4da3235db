"""Queries: nested enrichment and the coverage and details reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.functions.cleaning import has_text
from garimpo.operators import dedupe, nested, reports
from garimpo.operators.filters import nested_frame
from garimpo.plans.registry import Tables, query
from garimpo.plans.shapes import KEYS, attachments, items, money_sum, records, returned_orders

COVERAGE_SQL = """
SELECT CASE grouping(y, m) WHEN 3 THEN 'total' WHEN 1 THEN 'year' ELSE 'month' END AS grain,
  y AS year, m AS year_month, count(*) AS records, count(DISTINCT id) AS unique_ids
FROM (SELECT year(d)::INT AS y, strftime(d, '%Y-%m') AS m, id FROM src) GROUP BY GROUPING SETS ((), (y), (y, m))
"""


@query("A1 F1 D3", f"""WITH src AS (SELECT o_orderdate AS d, o_custkey AS id FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R'))
{COVERAGE_SQL}""")
def coverage_of_new_records(t: Tables):
    fresh = dedupe.new_records(t.orders, F.col("o_orderkey"), returned_orders(t))
    return reports.coverage(fresh, F.col("o_orderdate"), F.col("o_custkey"))


@query("A1", """
SELECT CASE grouping(y, m, d) WHEN 7 THEN 'total' WHEN 3 THEN 'year' WHEN 1 THEN 'month' ELSE 'day' END AS grain,
  y AS year, m AS year_month, d AS day, count(*) AS records, count(DISTINCT l_orderkey) AS unique_ids
FROM (SELECT year(l_shipdate)::INT AS y, strftime(l_shipdate, '%Y-%m') AS m, strftime(l_shipdate, '%Y-%m-%d') AS d,
  l_orderkey FROM lineitem) GROUP BY GROUPING SETS ((), (y), (y, m), (y, m, d))""")
def coverage_by_day(t: Tables):
    return reports.coverage(t.lineitem, F.col("l_shipdate"), F.col("l_orderkey"), detailed=True)


@query("A2 A3 A4", """
WITH src AS (SELECT try_cast(CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END
    AS DATE) AS d,
  CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE o_custkey::VARCHAR END || '-' || year(o_orderdate) AS id FROM orders),
g AS (SELECT CASE grouping(y, m) WHEN 3 THEN 'total' WHEN 1 THEN 'year' ELSE 'month' END AS grain,
  y AS year, m AS year_month, count(*) AS records, count(DISTINCT id) AS unique_ids
FROM (SELECT year(d)::INT AS y, strftime(d, '%Y-%m') AS m, id FROM src) GROUP BY GROUPING SETS ((), (y), (y, m)))
SELECT *, CASE WHEN records > unique_ids THEN records / unique_ids END AS avg_records FROM g""")
def coverage_with_fallback_id(t: Tables):
    company = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    landed = t.orders.select(
        F.struct(company.alias("cnpj")).alias("orgaoEntidade"),
        F.year("o_orderdate").alias("sequencialCompra"),
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown").otherwise(day).alias("dataPublicacaoPncp"),
        F.lit("2025-01-01T00:00:00").alias("ingestion_timestamp"),
    )
    report = reports.coverage(landed, reports.report_date(landed), reports.report_id(landed))
    return reports.records_per_id(report)


def failed_reads(t: Tables):
    return t.orders.where("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").cast("string").alias("cnpj"), F.year("o_orderdate").alias("anoCompra"),
        F.col("o_orderkey").alias("sequencialCompra"), F.lit("unreadable page").alias("error"))


def _enriched(t: Tables):
    return nested.enrich(
        records(t), KEYS, items(t), attachments(t), ["numeroItem", "partkey"], ["ordem"], failed_reads(t))


def _counted(t: Tables):
    return nested.enrichment_counts(records(t), KEYS, items(t), attachments(t), failed_reads(t))


ENRICHED_SQL = """
r AS (SELECT o_orderkey, o_orderdate, o_orderpriority = '5-LOW' OR o_orderkey = 0 AS no_key,
  o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS unreadable FROM orders),
i AS (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(15,2))::DOUBLE AS total FROM lineitem GROUP BY 1),
e AS (SELECT o_orderkey, o_orderdate, no_key, unreadable,
  CASE WHEN no_key OR unreadable THEN 0 ELSE coalesce(i.n, 0) END::INT AS itens,
  CASE WHEN no_key OR unreadable THEN 0 ELSE coalesce(total, 0) END AS valor,
  CASE WHEN no_key OR unreadable OR doc_id IS NULL THEN 0 ELSE 1 END AS arquivos,
  CASE WHEN no_key THEN 'Missing cnpj/ano/sequencial' WHEN unreadable THEN 'unreadable page' END AS fetch_error
  FROM r LEFT JOIN i ON l_orderkey = o_orderkey LEFT JOIN documents ON doc_id = o_orderkey)
"""


@query("N1 N2 N3 F10", f"""WITH {ENRICHED_SQL}
SELECT o_orderkey AS "sequencialCompra", itens AS total_itens, arquivos AS total_arquivos,
  CASE WHEN no_key THEN 0 ELSE 2 END AS api_calls, fetch_error, valor AS valor_itens FROM e""")
def enriched_records(t: Tables):
    return told(_enriched(t))


def told(enriched):
    """What a record's lists and metadata say, as columns."""
    value = F.aggregate(
        "itens", F.lit(0).cast("decimal(25,2)"),
        lambda acc, i: (acc + i["valor"].cast("decimal(15,2)")).cast("decimal(25,2)"))
    full = nested_frame(enriched)
    return full.select(
        "sequencialCompra", F.size("itens").alias("total_itens"), F.size("arquivos").alias("total_arquivos"),
        "metadata.api_calls", "metadata.fetch_error", value.cast("double").alias("valor_itens"))


@query("N4", f"""WITH {ENRICHED_SQL}
SELECT year(o_orderdate)::INT AS ano, count(*) AS processed, sum(itens)::BIGINT AS total_itens,
  sum(arquivos)::BIGINT AS total_arquivos, sum(CASE WHEN no_key THEN 0 ELSE 2 END)::BIGINT AS api_calls, count(fetch_error) AS errors FROM e GROUP BY 1""")
def enrichment_totals(t: Tables):
    return nested.enrichment_totals(_counted(t), ["anoCompra"]).withColumnRenamed("anoCompra", "ano")


@query("N5", """
WITH i AS (SELECT o_custkey, l_linenumber AS n, l_extendedprice::DECIMAL(15,2) AS v
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
SELECT o_custkey, n AS numero, count(*) AS rows, sum(v)::DOUBLE AS valor FROM i GROUP BY ALL""")
def flattened_items(t: Tables):
    lists = nested.child_lists(
        t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("numero"), F.col("l_extendedprice").alias("v")),
        ["l_orderkey"], ["numero", "v"], "itens")
    joined = t.orders.join(lists, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    flat = nested.flatten(joined, "itens", ["o_custkey"], outer=True)
    return flat.groupBy("o_custkey", "numero").agg(F.count("*").alias("rows"), money_sum("v").alias("valor"))


@query("A5", f"""WITH {ENRICHED_SQL}
SELECT count(*) AS total_contratacoes, sum(itens)::BIGINT AS total_itens, sum(arquivos)::BIGINT AS total_arquivos,
  round(sum(itens) / count(*), 2) AS avg_itens_per_contratacao,
  round(sum(arquivos) / count(*), 2) AS avg_arquivos_per_contratacao FROM e""")
def details_summary(t: Tables):
    return reports.details_summary(_counted(t), F.col("metadata.total_itens"), F.col("metadata.total_arquivos"))


@query("A6 N5", f"""WITH {ENRICHED_SQL},
l AS (SELECT l_returnflag, l_linestatus FROM e JOIN lineitem ON l_orderkey = o_orderkey WHERE fetch_error IS NULL)
SELECT 'categoria' AS kind, coalesce(nullif(l_returnflag, 'A'), 'Unknown') AS label, count(*) AS n FROM l GROUP BY 2
UNION ALL SELECT 'status', l_linestatus, count(*) FROM l GROUP BY 2""")
def item_frequencies(t: Tables):
    rows = nested.child_labels(
        records(t), KEYS, items(t), ["itemCategoriaNome", "situacaoCompraItemNome"], failed_reads(t))
    by_category = reports.frequency(rows, F.col("itemCategoriaNome"), weight="n").select(F.lit("categoria").alias("kind"), "*")
    by_status = reports.frequency(rows, F.col("situacaoCompraItemNome"), weight="n").select(F.lit("status").alias("kind"), "*")
    return by_category.unionByName(by_status)


@query("A7", f"""WITH {ENRICHED_SQL}
SELECT CASE lang WHEN 'en' THEN 'Edital' WHEN 'de' THEN 'Unknown' ELSE lang END AS label, count(*) AS n
FROM e JOIN documents ON doc_id = o_orderkey WHERE fetch_error IS NULL GROUP BY 1""")
def document_type_names(t: Tables):
    rows = nested.child_labels(
        records(t), KEYS, attachments(t), ["tipoDocumentoNome", "tipoDocumentoDescricao"], failed_reads(t))
    label = reports.document_label(F.col("tipoDocumentoNome"), F.col("tipoDocumentoDescricao"))
    return reports.frequency(rows, label, weight="n")


@query("A8", """
WITH f AS (SELECT p_brand AS label, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT label, n, n * 100.0::DOUBLE / sum(n) OVER () AS share_pct FROM f ORDER BY n DESC, label LIMIT 10""")
def top_categories(t: Tables):
    # Parts per line first, brands second: the part keys meet counts, not single lines.
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("lines"))
    brands = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    freq = brands.groupBy(F.col("p_brand").alias("label")).agg(F.sum("lines").alias("n"))
    return reports.with_share(freq, top=10)


@query("A8", """
WITH f AS (SELECT l_returnflag || l_linestatus AS label, count(*) AS n FROM lineitem GROUP BY 1)
SELECT label, n, n * 100.0::DOUBLE / sum(n) OVER () AS share_pct FROM f""")
def status_shares(t: Tables):
    return reports.with_share(reports.frequency(t.lineitem, F.concat("l_returnflag", "l_linestatus")))


@query("A9", f"""WITH {ENRICHED_SQL}
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS contratacoes, sum(itens)::BIGINT AS itens,
  sum(arquivos)::BIGINT AS arquivos FROM e GROUP BY 1""")
def daily_breakdown(t: Tables):
    return reports.daily_breakdown(
        _counted(t), F.col("dataPublicacaoPncp"), F.col("metadata.total_itens"), F.col("metadata.total_arquivos"))


@query("A10 D1", """
WITH c AS (SELECT count(*) AS a, count(DISTINCT (l_orderkey, l_linenumber)) AS b FROM lineitem)
SELECT a AS original_count, b AS final_count, a - b AS records_removed, (a - b) / a * 100 AS removal_rate FROM c""")
def transformation_summary(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return reports.transformation_summary(lines, lines.distinct())


@query("A13 T6", """
WITH d AS (SELECT o_orderdate::DATE AS day, count(*) AS fetched,
  count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS new_records
  FROM orders GROUP BY 1),
r AS (SELECT day, sum(fetched)::BIGINT AS fetched, sum(new_records)::BIGINT AS new_records,
  sum(CASE WHEN new_records > 0 THEN 1 ELSE 0 END)::BIGINT AS files FROM d GROUP BY ROLLUP (day))
SELECT *, fetched - new_records AS duplicates, (fetched - new_records) / fetched * 100 AS efficiency_rate FROM r""")
def backfill_totals(t: Tables):
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    flagged = dedupe.flag_new(dated, F.col("o_orderkey"), returned_orders(t), "is_new")
    return reports.backfill_totals(flagged, "day", "is_new")
