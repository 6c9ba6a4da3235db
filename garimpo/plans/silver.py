"""Queries: clean records, integrated join, market prices, histories, risk rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.operators.nested import ROWS_BYTES, parts_for
from garimpo.operators import gold, history, silver
from garimpo.operators.running import quantiles, range_bucket
from garimpo.plans.registry import Tables, query
from garimpo.plans.shapes import money

DURATION_DAYS = 30

REC_SQL = """
rec AS (SELECT o_orderkey, o_custkey, c_nationkey, o_orderdate::DATE AS d, o_totalprice::DECIMAL(15,2) AS v,
  o_totalprice AS price, o_orderstatus AS status, o_orderstatus = 'F' AS won, o_orderpriority AS cat,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
    ELSE o_orderdate::DATE + 30 * o_orderpriority[1:1]::INT END AS fim,
  o_totalprice / 500000 AS score FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
"""


def contracts(t: Tables):
    """Orders as contracts: company = customer, buyer = nation, urgent pending ones run on without end."""
    days = F.substring("o_orderpriority", 1, 1).cast("int") * DURATION_DAYS
    open_end = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), money("o_totalprice").alias("v"),
        F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"),
        (F.col("o_orderstatus") == "F").alias("won"), F.col("o_orderpriority").alias("cat"),
        F.when(~open_end, F.date_add("o_orderdate", days)).alias("fim"),
        (F.col("o_totalprice") / 500000).alias("score"),
    )
    nations = t.customer.select("c_custkey", "c_nationkey")
    return orders.join(nations, F.col("c_custkey") == F.col("o_custkey"), "left").drop("c_custkey")


@query("B1", """
WITH raw AS (SELECT *, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice::DECIMAL(15,2) END AS valor,
  CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN o_custkey END AS empresa FROM orders)
SELECT o_orderkey, valor::DOUBLE AS valor, empresa::VARCHAR AS empresa, o_orderdate::DATE AS data,
  upper(o_orderpriority) || ' X' AS modalidade FROM raw WHERE valor IS NOT NULL AND empresa IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) = 1""")
def cleaned_records(t: Tables):
    keep = (F.col("o_orderstatus") != "P") | (F.col("o_orderpriority") != "5-LOW")
    raw = t.orders.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "n/d").otherwise(money("o_totalprice").cast("string")).alias("valor"),
        F.when(keep, F.col("o_custkey").cast("string")).alias("empresa"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("data"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit("   x ")).alias("modalidade"),
    )
    cleaned = silver.clean(
        raw, ["o_custkey", "ano"], ["o_orderkey"], ["valor", "empresa"], ["valor"], ["data"], ["modalidade"])
    return cleaned.select("o_orderkey", F.col("valor").cast("double").alias("valor"), "empresa", "data", "modalidade")


@query("B2", f"""WITH {REC_SQL}
SELECT o_orderkey || '-' || year(d) AS licitacao_id, CASE WHEN won THEN (v - 1000)::DOUBLE ELSE price END AS valor_final,
  lpad(o_custkey::VARCHAR, 14, '0') AS cnpj,
  regexp_replace(lpad(o_custkey::VARCHAR, 14, '0'), '(..)(...)(...)(....)(..)', '\\1.\\2.\\3/\\4-\\5') AS cnpj_formatado,
  fim - d AS dias_duracao FROM rec""")
def derived_columns(t: Tables):
    base = contracts(t).withColumns({
        "ano": F.year("d"), "homologado": F.when(F.col("won"), (F.col("v") - 1000).cast("double")),
        "raw": F.lpad(F.col("o_custkey").cast("string"), 14, "0"),
    })
    full = silver.derive(base, "o_orderkey", "ano", "homologado", "price", "raw", {"dias_duracao": ("d", "fim")})
    return full.select(
        "licitacao_id", "valor_final", "cnpj", "cnpj_formatado", F.col("dias_duracao").cast("long").alias("dias_duracao"))


@query("B3", f"""WITH {REC_SQL},
ceis AS (SELECT * FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1),
cnep AS (SELECT * FROM supplier WHERE s_acctbal < 5000
  QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) = 1)
SELECT o_orderkey, c_name AS empresa, ceis.s_name AS ceis, cnep.s_name AS cnep, lang AS idioma, quality AS analise
FROM rec LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN ceis ON ceis.s_nationkey = rec.c_nationkey
LEFT JOIN cnep ON cnep.s_nationkey = rec.c_nationkey LEFT JOIN documents ON doc_id = o_orderkey
LEFT JOIN labels l ON l.doc_id = o_orderkey""")
def integrated_records(t: Tables):
    return silver.integrate(contracts(t), [
        silver.Side(t.customer, {"o_custkey": "c_custkey"}, ["c_name"], {"empresa": "c_name"}),
        silver.Side(t.supplier, {"c_nationkey": "s_nationkey"}, ["s_suppkey"], {"ceis": "s_name"}),
        silver.Side(t.supplier.where("s_acctbal < 5000"), {"c_nationkey": "s_nationkey"}, ["s_acctbal", "s_suppkey"],
                    {"cnep": "s_name"}),
        silver.Side(t.documents.select("doc_id", "lang"), {"o_orderkey": "doc_id"}, ["lang"], {"idioma": "lang"}),
        silver.Side(t.labels, {"o_orderkey": "doc_id"}, ["quality"], {"analise": "quality"}),
    ]).select("o_orderkey", "empresa", "ceis", "cnep", "idioma", "analise")


@query("B4", f"""WITH {REC_SQL}, s AS (SELECT o_custkey, d, fim FROM rec WHERE status = 'P')
SELECT o_orderkey, EXISTS (SELECT 1 FROM s WHERE s.o_custkey = r.o_custkey AND s.d <= r.d
  AND r.d <= coalesce(s.fim, DATE '9999-12-31')) AS sancionada FROM rec r""")
def sanctioned_records(t: Tables):
    base = contracts(t)
    sanctions = base.where("status = 'P'").select("o_custkey", "d", "fim")
    flagged = history.active_at(base.select("o_orderkey", "o_custkey", "d"), "o_custkey", "d", sanctions, "d", "fim", "sancionada")
    return flagged.select("o_orderkey", "sancionada")


@query("B8", """
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY 1),
k AS (SELECT e.* FROM events e JOIN s USING (event_type) WHERE abs((value - m) / sd) <= 3)
SELECT user_id, upper(event_type) AS categoria, value, event_id FROM k
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY event_id) = 1""")
def normalised_prices(t: Tables):
    raw = t.events.select("event_id", "user_id", "value", F.concat(F.lit(" "), "event_type").alias("categoria"))
    kept = silver.normalise_prices(raw, "categoria", "value", ["user_id", "categoria", "value"], ["event_id"])
    return kept.select("user_id", "categoria", "value", "event_id")


@query("B9", """
SELECT p_type, p_brand, round(avg(l_extendedprice) + 1e-7, 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75,
  round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95,
  round(stddev_samp(l_extendedprice), 4) AS sd, count(*) AS n, min(l_shipdate)::DATE AS first_date,
  max(l_shipdate)::DATE AS last_date, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS marketplaces
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def price_reference(t: Tables):
    prices = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "p_type", "p_brand", "l_extendedprice", F.to_date("l_shipdate").alias("shipped"), "l_returnflag")
    ref = gold.price_reference(prices, ["p_type", "p_brand"], "l_extendedprice", "shipped", "l_returnflag")
    # The mean is shifted by far less than a digit, off the ties a mean of few cents can hit.
    mean = F.round(F.col("mean") + 1e-7, 4).alias("mean")
    rounded = [F.round(c, 4).alias(c) for c in ("median", "p25", "p75", "p90", "p95", "sd")]
    return ref.select(
        "p_type", "p_brand", mean, *rounded, "n", "first_date", "last_date",
        F.concat_ws(",", "marketplaces").alias("marketplaces"))


@query("B12 B27", f"""WITH {REC_SQL},
h AS (SELECT *, count(*) OVER w AS previous_count, coalesce(sum(v) OVER w, 0)::DOUBLE AS previous_value,
  sum(won::INT) OVER w AS wins, min(d) OVER w AS f, max(d) OVER w AS l FROM rec
  WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_orderkey, previous_count, previous_value, wins / nullif(previous_count, 0) AS win_rate,
  d - l AS days_since_previous,
  round(((year(d) - year(f)) * 12 + month(d) - month(f) + CASE WHEN day(d) = day(f)
    OR (d = last_day(d) AND f = last_day(f)) THEN 0 ELSE (day(d) - day(f)) / 31 END) / 12, 6) AS age_years,
  (SELECT count(*) FROM rec p WHERE p.o_custkey = h.o_custkey AND (p.d < h.d OR (p.d = h.d AND p.o_orderkey < h.o_orderkey))
    AND (p.fim IS NULL OR p.fim >= h.d)) AS active_contracts FROM h""")
def company_history(t: Tables):
    known = history.company_history(contracts(t), "o_custkey", "d", "o_orderkey", F.col("v"), F.col("won"), "fim")
    return known.select(
        "o_orderkey", "previous_count", F.col("previous_value").cast("double").alias("previous_value"), "win_rate",
        F.col("days_since_previous").cast("long").alias("days_since_previous"),
        F.round("age_years", 6).alias("age_years"), "active_contracts")


@query("B13", f"""WITH {REC_SQL},
h AS (SELECT *, count(*) OVER w AS n, sum(v) OVER w AS total, sum((score > 0.8)::INT) OVER w AS s FROM rec
  WINDOW w AS (PARTITION BY c_nationkey ORDER BY d, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_orderkey, n AS buyer_previous_count, total::DOUBLE / nullif(n, 0) AS buyer_mean_value,
  s / nullif(n, 0) AS buyer_suspicion_rate FROM h""")
def buyer_history(t: Tables):
    known = history.buyer_history(
        contracts(t), "c_nationkey", ["d", "o_orderkey"], "d", F.col("v"), F.col("score") > 0.8)
    return known.select("o_orderkey", "buyer_previous_count", "buyer_mean_value", "buyer_suspicion_rate")


@query("B4 T-5", f"""WITH {REC_SQL},
s AS (SELECT o_custkey, l_shipdate::DATE AS a, l_shipdate::DATE + (l_linenumber * 20 - 60) AS b
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_orderkey, EXISTS (SELECT 1 FROM s WHERE s.o_custkey = rec.o_custkey AND a <= b AND d BETWEEN a AND b) AS sancionada
FROM rec""")
def inverted_sanctions(t: Tables):
    """Sanctions of which some end before they begin; those take nothing from the valid ones."""
    lines = t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("a"), "l_linenumber")
    lines = lines.withColumn("b", F.date_add("a", F.col("l_linenumber") * 20 - 60))
    lines = lines.repartition(parts_for(lines, ROWS_BYTES), "l_orderkey")
    owned = lines.join(t.orders.select("o_orderkey", "o_custkey").hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "a", "b")
    return history.active_at(contracts(t), "o_custkey", "d", owned, "a", "b", "sancionada").select("o_orderkey", "sancionada")


@query("B12 B27", f"""WITH {REC_SQL},
r AS (SELECT *, d + (o_orderpriority[1:1]::INT * 30 - 60) AS e FROM rec JOIN orders USING (o_orderkey))
SELECT x.o_orderkey, (SELECT count(*) FROM r y WHERE y.o_custkey = x.o_custkey AND y.d <= y.e
  AND (y.d < x.d OR (y.d = x.d AND y.o_orderkey < x.o_orderkey)) AND y.e >= x.d) AS active_contracts FROM rec x""")
def inverted_contracts(t: Tables):
    """Contracts of which some end before they begin: those never run."""
    priority = t.orders.select("o_orderkey", (F.substring("o_orderpriority", 1, 1).cast("int") * 30 - 60).alias("days"))
    base = contracts(t).join(priority, "o_orderkey", "left")
    base = base.withColumn("e", F.date_add("d", F.col("days")))
    known = history.company_history(base, "o_custkey", "d", "o_orderkey", F.col("v"), F.col("won"), "e")
    return known.select("o_orderkey", "active_contracts")


@query("B9 B25", """
WITH e AS (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 3 = 0 THEN value / 1000
  ELSE -value END AS v FROM events)
SELECT event_type, round(quantile_cont(v, 0.25), 9) AS p25, round(quantile_cont(v, 0.5), 9) AS p50,
  round(quantile_cont(v, 0.85), 9) AS p85 FROM e GROUP BY 1""")
def quantiles_with_nan(t: Tables):
    """Not-a-number sorts above every number, as it does in a sort."""
    odd = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 3 == 0, F.col("value") / 1000).otherwise(-F.col("value"))
    found = quantiles(t.events.withColumn("v", odd), ["event_type"], "v", {"p25": 0.25, "p50": 0.5, "p85": 0.85})
    return found.select("event_type", *(F.round(c, 9).alias(c) for c in ("p25", "p50", "p85")))


@query("B28", f"""WITH {REC_SQL},
h AS (SELECT o_orderkey, avg((score > 0.8)::INT) OVER (PARTITION BY c_nationkey, cat ORDER BY d, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS own,
  avg((score > 0.8)::INT) OVER (ORDER BY d, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS every FROM rec)
SELECT o_orderkey, coalesce(own, every) AS encoded FROM h""")
def target_encoding(t: Tables):
    base = contracts(t).withColumn("group", F.concat_ws("|", F.col("c_nationkey").cast("string"), "cat"))
    label = (F.col("score") > 0.8).cast("int")
    parts = range_bucket(F.col("o_orderkey"), 1 << 20)
    known = history.target_encoding(base, "group", ["d", "o_orderkey"], "d", label, "encoded", parts)
    return known.select("o_orderkey", "encoded")


@query("B10", f"""WITH {REC_SQL},
m AS (SELECT cat, avg(price) AS mean, quantile_cont(price, 0.95) AS p95 FROM rec WHERE won GROUP BY 1),
s AS (SELECT cat, avg(price) AS mean, stddev_samp(price) AS sd, median(price) AS med FROM rec GROUP BY 1),
h AS (SELECT *, sum(v) OVER w AS total, count(*) OVER w AS n,
  percent_rank() OVER (PARTITION BY cat ORDER BY price) AS pr FROM rec
  WINDOW w AS (PARTITION BY c_nationkey ORDER BY d, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_orderkey, round(ln(price), 6) AS log_valor_total, round(price / s.mean, 6) AS preco_vs_media_categoria,
  round(price / med, 6) AS preco_vs_mediana_categoria, round((price - s.mean) / sd, 6) AS zscore_preco,
  pr AS percentile_preco, round(price / m.mean, 6) AS preco_vs_mercado, round(price / p95, 6) AS preco_vs_p95_mercado,
  round((price - total::DOUBLE / n) / (total::DOUBLE / n), 6) AS desvio_preco_historico_orgao
FROM h JOIN s USING (cat) JOIN m USING (cat)""")
def price_features(t: Tables):
    base = contracts(t)
    market = gold.price_reference(base.where("won"), ["cat"], "price", "d", "status", {"p95": 0.95})
    known = history.buyer_history(base, "c_nationkey", ["d", "o_orderkey"], "d", F.col("v"), F.col("score") > 0.8)
    full = gold.price_features(known, "cat", "price", market, "buyer_mean_value")
    names = ["log_valor_total", "preco_vs_media_categoria", "preco_vs_mediana_categoria", "zscore_preco",
             "preco_vs_mercado", "preco_vs_p95_mercado", "desvio_preco_historico_orgao"]
    return full.select("o_orderkey", "percentile_preco", *(F.round(n, 6).alias(n) for n in names))


@query("B33", f"""WITH {REC_SQL},
m AS (SELECT cat, median(price) AS med FROM rec GROUP BY 1)
SELECT o_orderkey, price > 1.8 * med AS superfaturado FROM rec JOIN m USING (cat)""")
def overpriced_records(t: Tables):
    return gold.overprice(contracts(t), "cat", "price", 1.8, "superfaturado").select("o_orderkey", "superfaturado")


@query("B33", f"""WITH {REC_SQL},
i AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(15,2)) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey, abs(v - coalesce(s, 0)) > 100000 AS inconsistente FROM rec LEFT JOIN i ON l_orderkey = o_orderkey""")
def inconsistent_totals(t: Tables):
    flagged = gold.total_mismatch(
        contracts(t), "o_orderkey", F.col("v"), t.lineitem, "l_orderkey", money("l_extendedprice"), 100000.0, "inconsistente")
    return flagged.select("o_orderkey", "inconsistente")


@query("B33", f"""WITH {REC_SQL},
p AS (SELECT DISTINCT c_nationkey, l_partkey, o_orderkey, d FROM rec JOIN lineitem ON l_orderkey = o_orderkey)
SELECT o_orderkey, l_partkey, EXISTS (SELECT 1 FROM p q WHERE q.c_nationkey = p.c_nationkey AND q.l_partkey = p.l_partkey
  AND (q.d < p.d OR (q.d = p.d AND q.o_orderkey < p.o_orderkey)) AND q.d + 180 >= p.d) AS desnecessaria FROM p""")
def needless_purchases(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    bought = contracts(t).join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "c_nationkey", "l_partkey", "o_orderkey", "d").distinct().withColumn("until", F.date_add("d", 180))
    flagged = history.overlaps_earlier(bought, ["c_nationkey", "l_partkey"], "d", "until", "o_orderkey", "desnecessaria")
    return flagged.select("o_orderkey", "l_partkey", "desnecessaria")


@query("B24", """
WITH ref AS (SELECT p_brand, quantile_cont(l_extendedprice, 0.5) AS price FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_quantity = 1 AND p_type = 'PROMO' GROUP BY 1)
SELECT p_brand, count(*) AS records, count(price) AS covered, count(price) / count(*) AS coverage
FROM part LEFT JOIN ref USING (p_brand) GROUP BY 1""")
def reference_coverage(t: Tables):
    promo = t.part.where("p_type = 'PROMO'")
    single = t.lineitem.where("l_quantity = 1").join(promo, F.col("p_partkey") == F.col("l_partkey"))
    ref = gold.price_reference(single, ["p_brand"], "l_extendedprice", "l_shipdate", "l_returnflag", {"median": 0.5})
    return gold.reference_coverage(t.part, "p_brand", ref, "median")
