"""Queries: features, labels, splits, texts, similarity, profiles, statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from garimpo.functions.text import tokens
from garimpo.operators import gold, name_links, notices, price_sketch, similar, text_index
from garimpo.plans.registry import Tables, query
from garimpo.plans.silver import REC_SQL, contracts
from garimpo.session import fresh_path

SPLIT_SQL = """CASE WHEN ('0x' || md5(o_orderkey::VARCHAR)[1:8])::BIGINT % 100 < 70 THEN 'train'
  WHEN ('0x' || md5(o_orderkey::VARCHAR)[1:8])::BIGINT % 100 < 85 THEN 'validation' ELSE 'test' END"""


@query("B11", f"""WITH {REC_SQL}
SELECT o_orderkey, dayofweek(d) + 1 AS dia_semana, month(d) AS mes, quarter(d) AS trimestre, year(d) AS ano,
  fim - d AS dias_duracao FROM rec""")
def temporal_features(t: Tables):
    out = gold.temporal_features(contracts(t), "d", {"dias_duracao": ("d", "fim")})
    whole = ["dia_semana", "mes", "trimestre", "ano", "dias_duracao"]
    return out.select("o_orderkey", *(F.col(c).cast("long").alias(c) for c in whole))


UF_SQL = "['AC','AM','AP','PA','RO','RR','TO','AL','BA','CE','MA','PB','PE','PI','RN','SE','DF','GO','MS','MT','ES','MG','RJ','SP','XX']"


@query("B14", f"""
WITH c AS (SELECT c_custkey, {UF_SQL}[c_nationkey + 1] AS uf, c_mktsegment[1:1] AS s FROM customer)
SELECT c_custkey, CASE s WHEN 'M' THEN 'Municipal' WHEN 'F' THEN 'Federal' END AS esfera,
  CASE WHEN uf IN ('AC','AM','AP','PA','RO','RR','TO') THEN 'Norte' WHEN uf IN ('DF','GO','MS','MT') THEN 'Centro-Oeste'
    WHEN uf IN ('ES','MG','RJ','SP') THEN 'Sudeste' WHEN uf <> 'XX' THEN 'Nordeste' END AS regiao FROM c""")
def encoded_places(t: Tables):
    states = F.array(*(F.lit(x) for x in UF_SQL.strip("[]").replace("'", "").split(",")))
    coded = t.customer.select(
        "c_custkey", F.substring("c_mktsegment", 1, 1).alias("esfera_id"),
        F.element_at(states, F.col("c_nationkey") + 1).alias("estado"))
    return gold.encode_place(coded, "esfera_id", "estado").select("c_custkey", "esfera", "regiao")


@query("B29", f"""WITH {REC_SQL}
SELECT cat || '_' || status || '_' || c_nationkey AS interaction, count(*) AS n FROM rec GROUP BY 1""")
def category_region_interaction(t: Tables):
    base = contracts(t).withColumn("n", F.col("c_nationkey").cast("string"))
    return gold.interaction(base, ["cat", "status", "n"])


@query("B7", """SELECT doc_id, (length(lang) / n_chars) * 0.7 + coalesce(quality, toxic)::DOUBLE * 0.3 AS score
FROM documents LEFT JOIN labels USING (doc_id)""")
def combined_scores(t: Tables):
    both = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    llm = F.coalesce("quality", "toxic").cast("double")
    return both.select("doc_id", gold.combined_score(gold.ratio(F.length("lang"), F.col("n_chars")), llm).alias("score"))


@query("B6", """
WITH f AS (SELECT doc_id, CAST(n_chars % 10 < 5 AS INT) AS flag_prazo_curto,
  CAST(regexp_matches(text, '\\b(The|Les|Und) [a-z]+tion') AS INT) AS flag_marca_especifica,
  CAST(contains(lower(text), 'license') OR contains(lower(text), 'eauion') AS INT) AS flag_requisitos_excessivos,
  CAST(coalesce(n, 0) > 3 AS INT) AS flag_valores_inconsistentes
  FROM documents LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
    ON l_orderkey = doc_id)
SELECT *, (flag_prazo_curto + flag_marca_especifica + flag_requisitos_excessivos + flag_valores_inconsistentes) / 4 AS score
FROM f""")
def notice_rules(t: Tables):
    priceless = t.lineitem.where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        (F.count("*") - 3).alias("priceless"))
    docs = t.documents.join(priceless, "doc_id", "left")
    flags = notices.rule_flags(
        F.col("text"), F.pmod("n_chars", F.lit(10)), F.col("priceless"), r"\b(The|Les|Und) [a-z]+tion", ["License", "Eauion"])
    scored = notices.with_rule_score(docs, flags, "score")
    return scored.select("doc_id", *(F.col(c).cast("int").alias(c) for c in flags), "score")


@query("B15 B16", f"""WITH {REC_SQL}, m AS (SELECT cat, median(price) AS med FROM rec GROUP BY 1),
l AS (SELECT o_orderkey, (status = 'P' AND cat = '1-URGENT') OR score > 0.8 OR price > 2 * med AS label
  FROM rec JOIN m USING (cat))
SELECT o_orderkey, label, {SPLIT_SQL} AS split FROM l""")
def labelled_split(t: Tables):
    base = contracts(t)
    ref = gold.price_reference(base, ["cat"], "price", "d", "status", {"median": 0.5}).select("cat", "median")
    sanctioned = F.when(F.col("status") == "P", F.col("cat") == "1-URGENT")
    label = gold.weak_label(sanctioned, F.col("score"), F.col("price"), F.col("median"))
    return base.join(ref, "cat", "left").select(
        "o_orderkey", label.alias("label"), gold.hash_split(F.col("o_orderkey")).alias("split"))


@query("B31", f"""WITH {REC_SQL}, s AS (SELECT CASE WHEN d < DATE '2000-01-01' THEN 'train'
  WHEN d < DATE '2001-01-01' THEN 'validation' ELSE 'test' END AS split, score > 0.8 AS label FROM rec)
SELECT split, label, n, n / sum(n) OVER (PARTITION BY split) AS share
FROM (SELECT split, label, count(*) AS n FROM s GROUP BY split, label)""")
def class_balance(t: Tables):
    return gold.class_balance(
        contracts(t), gold.temporal_split(F.col("d"), "2000-01-01", "2001-01-01"), F.col("score") > 0.8)


@query("B17 Q3", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
q AS (SELECT * FROM e WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS probe, e.vec_id, list_cosine_similarity(q.v, e.v) AS sim FROM q JOIN e ON q.vec_id <> e.vec_id)
SELECT probe, vec_id, round(sim, 9) AS similarity, row_number() OVER (PARTITION BY probe ORDER BY sim DESC, vec_id)::INT AS rank
FROM s QUALIFY row_number() OVER (PARTITION BY probe ORDER BY sim DESC, vec_id) <= 10""")
def similar_records(t: Tables):
    # The stated query set: every vector whose id is divisible by 50, against all vectors.
    probes = t.embeddings.where("vec_id % 50 = 0")
    best = similar.similar_batch(t.embeddings, "vec_id", "embedding", probes)
    return best.select("probe", "vec_id", F.round("similarity", 9).alias("similarity"), "rank")


@query("B17", """
WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 7)
SELECT e.vec_id, round(list_cosine_similarity(q.v, e.embedding::DOUBLE[]), 9) AS similarity
FROM embeddings e, q WHERE e.vec_id <> 7
ORDER BY list_cosine_similarity(q.v, e.embedding::DOUBLE[]) DESC, e.vec_id LIMIT 10""")
def similar_to_record(t: Tables):
    best = similar.similar_to_id(t.embeddings, "vec_id", "embedding", 7)
    return best.select("vec_id", F.round("similarity", 9).alias("similarity"))


TERMS = ("the", "license", "eau", "ing")


SEARCH_SQL = """
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents)
SELECT doc_id, count(*) AS score FROM w WHERE term IN ('the', 'license', 'eau', 'ing')
GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 20"""


@query("B18", SEARCH_SQL)
def text_search(t: Tables):
    found = notices.search(t.documents, "doc_id", "text", TERMS, 20)
    return found.select("doc_id", F.col("score").cast("long").alias("score"))


@query("B18", SEARCH_SQL)
def indexed_search(t: Tables):
    path = fresh_path(t.spark, "text-index")
    text_index.write_index(t.documents, "doc_id", "text", path)
    found = text_index.search_index(t.spark, path, TERMS, 20)
    return found.select(F.col("id").alias("doc_id"), F.col("score").cast("long").alias("score"))


WORDS_SQL = """
w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
x AS (SELECT doc_id, term, tf, df, tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS weight
  FROM tf JOIN df USING (term))"""


@query("B30", f"""WITH {WORDS_SQL}
SELECT doc_id, count(*) AS terms, sum(tf)::BIGINT AS words, sum(df)::BIGINT AS df_sum, round(sum(weight), 4) AS weight
FROM x GROUP BY 1""")
def term_weights(t: Tables):
    weights = notices.tf_idf(t.documents, "doc_id", "text")
    return weights.groupBy("doc_id").agg(
        F.count("*").alias("terms"), F.sum("tf").alias("words"), F.sum("df").alias("df_sum"),
        F.round(F.sum("weight"), 4).alias("weight"))


@query("B30", f"""WITH {WORDS_SQL}, r AS (SELECT doc_id, term, tf, row_number() OVER (PARTITION BY doc_id
  ORDER BY round(weight, 9) DESC, term)::INT AS rank FROM x)
SELECT * FROM r WHERE rank <= 3""")
def top_terms(t: Tables):
    # Equal weights may differ in the last bit between engines, so ties are settled on rounded ones.
    weights = notices.tf_idf(t.documents, "doc_id", "text").withColumn("weight", F.round("weight", 9))
    best = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "term")
    ranked = weights.withColumn("rank", F.row_number().over(best)).where("rank <= 3")
    return ranked.select("doc_id", "term", "tf", "rank")


@query("B19", f"""WITH {REC_SQL}
SELECT o_orderkey, score FROM rec WHERE score >= 0.7 ORDER BY score DESC, o_orderkey LIMIT 50 OFFSET 25""")
def record_page(t: Tables):
    return gold.record_query(contracts(t), "score", "o_orderkey", 0.7, limit=50, offset=25).select("o_orderkey", "score")


@query("B20", f"""WITH {REC_SQL} SELECT cat, status, count(*) AS records, sum(v)::DOUBLE AS total_value,
  count(*) FILTER (score > 0.8) AS suspicious, count(*) FILTER (score > 0.8) / count(*) AS share_suspicious
FROM rec GROUP BY ALL""")
def stats_by_category(t: Tables):
    return gold.score_stats(contracts(t), ["cat", "status"], "score", F.col("v")).drop("mean_score")


@query("B20", f"""WITH {REC_SQL} SELECT date_trunc('month', d)::DATE AS month, count(*) AS records,
  sum(v)::DOUBLE AS total_value, count(*) FILTER (score > 0.8) AS suspicious FROM rec GROUP BY 1""")
def timeline(t: Tables):
    stats = gold.score_stats(contracts(t), [F.trunc("d", "month").alias("month")], "score", F.col("v"))
    return stats.select("month", "records", "total_value", "suspicious")


@query("B20", f"""WITH {REC_SQL} SELECT c_nationkey, count(*) AS records, sum(v)::DOUBLE AS total_value,
  round(avg(score), 3) AS mean_score FROM rec GROUP BY 1 ORDER BY total_value DESC, c_nationkey LIMIT 10""")
def top_buyers(t: Tables):
    stats = gold.score_stats(contracts(t), ["c_nationkey"], "score", F.col("v"))
    best = stats.orderBy(F.desc("total_value"), "c_nationkey").limit(10)
    return best.select("c_nationkey", "records", "total_value", F.round("mean_score", 3).alias("mean_score"))


@query("B21", f"""WITH {REC_SQL}, r AS (SELECT d, o_orderkey, row_number() OVER (PARTITION BY d
  ORDER BY score DESC, o_orderkey)::INT AS rank FROM rec WHERE score > 0.8)
SELECT * FROM r WHERE rank <= 20""")
def explain_queue(t: Tables):
    return gold.explain_queue(contracts(t), "d", "score", "o_orderkey").select("d", "o_orderkey", "rank")


@query("B34", f"""WITH {REC_SQL} SELECT o_orderkey, CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.6 THEN 'medium'
  WHEN score < 0.8 THEN 'high' ELSE 'critical' END AS severity FROM rec""")
def severity_bands(t: Tables):
    return contracts(t).select("o_orderkey", gold.severity(F.col("score")).alias("severity"))


@query("B23", """
SELECT * FROM (SELECT count(*) AS rows, unnest([
  {'check': 'date_present', 'violations': count(*) FILTER (l_shipdate IS NULL)},
  {'check': 'discount_range', 'violations': count(*) FILTER (l_discount < 0 OR l_discount > 0.09)},
  {'check': 'flag_format', 'violations': count(*) FILTER (l_returnflag NOT IN ('A', 'R'))},
  {'check': 'part_known', 'violations': count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 50))},
  {'check': 'unique_l_orderkey', 'violations': count(*) - count(DISTINCT l_orderkey)}], recursive := true) FROM lineitem)
  t(rows, "check", violations), LATERAL (SELECT violations = 0 AS passed)""")
def quality_checks(t: Tables):
    known = gold.with_reference(t.lineitem, "l_partkey", t.part.where("p_size < 50"), "p_partkey", "part_ok")
    return gold.quality_checks(known, {
        "date_present": F.col("l_shipdate").isNotNull(),
        "discount_range": F.col("l_discount").between(0, 0.09),
        "flag_format": F.col("l_returnflag").rlike("^[AR]$"),
        "part_known": F.col("part_ok"),
    }, unique=["l_orderkey"])


# A mean of cents over 8 or 16 rows can lie exactly between two roundings, where the order of
# summation decides; both sides shift it by far less than the last digit shown.
PROFILE_SQL = """count(*) AS rows, count(*) - count({v}) AS nulls, count(DISTINCT {v}) AS distinct_values,
  min({v}) AS min, max({v}) AS max, round(avg({v}) + 1e-7, 4) AS mean, round(stddev_samp({v}), 4) AS sd,
  round(quantile_cont({v}, 0.25), 4) AS q1, round(quantile_cont({v}, 0.5), 4) AS q2, round(quantile_cont({v}, 0.75), 4) AS q3"""


def _rounded(df, keys):
    plain = ["rows", "nulls", "distinct_values", "min", "max"]
    mean = F.round(F.col("mean") + 1e-7, 4).alias("mean")
    return df.select(*keys, *plain, mean, *(F.round(c, 4).alias(c) for c in ("sd", "q1", "q2", "q3")))


@query("B25", f"""WITH {REC_SQL}, p AS (SELECT cat, c_nationkey, CASE WHEN status <> 'P' THEN price END AS x FROM rec)
SELECT cat, c_nationkey, {PROFILE_SQL.format(v='x')} FROM p GROUP BY ALL""")
def distribution_profile(t: Tables):
    base = contracts(t).withColumn("x", F.when(F.col("status") != "P", F.col("price")))
    return _rounded(gold.profile(base, ["cat", "c_nationkey"], "x"), ["cat", "c_nationkey"])


@query("B25", f"""
WITH u AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem UNION ALL
  SELECT 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem)
SELECT "column", {PROFILE_SQL.format(v='x')} FROM u GROUP BY 1""")
def column_profile(t: Tables):
    return _rounded(gold.profile_columns(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]), ["column"])


@query("B26", """
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem""")
def correlations(t: Tables):
    pairs = gold.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"])
    return pairs.select("a", "b", F.round("corr", 6).alias("corr"))


@query("B32", f"""WITH {REC_SQL}, u(unit) AS (VALUES ('month'), ('quarter')),
g AS (SELECT unit, CASE unit WHEN 'month' THEN date_trunc('month', d) ELSE date_trunc('quarter', d) END::DATE AS period,
  count(*) AS records, sum(v)::DOUBLE AS total FROM rec, u GROUP BY ALL)
SELECT a.unit, a.period, a.records, a.total, (a.total - b.total) / b.total AS change_yoy
FROM g a LEFT JOIN g b ON b.unit = a.unit AND b.period + INTERVAL 12 MONTH = a.period""")
def seasonality(t: Tables):
    base = contracts(t)
    monthly = gold.seasonality(base, "d", F.col("v"), "month").select(F.lit("month").alias("unit"), "*")
    quarterly = gold.seasonality(base, "d", F.col("v"), "quarter").select(F.lit("quarter").alias("unit"), "*")
    return monthly.unionByName(quarterly)


@query("B27", f"""WITH {REC_SQL}, pop AS (SELECT c_nationkey, count(*) AS people FROM customer WHERE c_nationkey <> 3 GROUP BY 1)
SELECT o_orderkey, price / people AS valor_por_habitante FROM rec LEFT JOIN pop USING (c_nationkey)""")
def value_per_inhabitant(t: Tables):
    people = t.customer.where("c_nationkey <> 3").groupBy("c_nationkey").agg(F.count("*").alias("people"))
    out = gold.per_inhabitant(contracts(t), "c_nationkey", F.col("price"), people, "people")
    return out.select("o_orderkey", "valor_por_habitante")


@query("B27", """SELECT doc_id, length(text) AS chars,
len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS words FROM documents""")
def notice_length(t: Tables):
    return t.documents.select(
        "doc_id", F.length("text").cast("long").alias("chars"), F.size(tokens(F.col("text"))).cast("long").alias("words"))


NAME_SQL = """
n AS (SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS name FROM part),
g AS (SELECT name, list_distinct(flatten(list_transform(
  list_filter(regexp_split_to_array(lower(name), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''),
  lambda w: list_transform(range(1, length(w) + 2), lambda i: ('  ' || w || ' ')[i:i + 2])))) AS g
  FROM (SELECT DISTINCT name FROM n)),
p AS (SELECT a.name, b.name AS other FROM g a JOIN g b ON a.name <> b.name
  WHERE 170 * len(list_intersect(a.g, b.g)) >= 70 * (len(a.g) + len(b.g))),
r AS (SELECT name, min(other) AS other, count(*) AS links FROM p GROUP BY 1)"""


@query("Q4", f"""WITH {NAME_SQL}
SELECT p_partkey, name, least(name, coalesce(other, name)) AS representative, coalesce(links, 0) AS links
FROM n LEFT JOIN r USING (name)""")
def represented_names(t: Tables):
    named = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name"))
    return name_links.represented(named, "p_partkey", "name", 70)


# The ranks of the sketch's quantiles stay within three times its stated error.
RANK_ERROR = 0.02


@query("B9 B25", f"""WITH {REC_SQL}, s AS (SELECT *, CASE WHEN d < DATE '2000-01-01' THEN 'before' ELSE 'since' END AS span FROM rec)
SELECT cat, span, count(price) AS n, round(avg(price) + 1e-7, 4) AS mean, min(price) AS low, max(price) AS high,
  true AS median_near, true AS p25_near, true AS p75_near, true AS p90_near, true AS p95_near FROM s GROUP BY ALL""")
def sketched_reference(t: Tables):
    base = contracts(t)
    path = fresh_path(t.spark, "daily-references")
    price_sketch.daily_references(base, ["cat"], "d", "price").write.parquet(path)
    daily = t.spark.read.parquet(path)
    turn, parts = F.lit("2000-01-01").cast("date"), []
    for span, first, last, rows in (
        ("before", None, F.date_sub(turn, 1), base.where(F.col("d") < turn)),
        ("since", turn, None, base.where(F.col("d") >= turn)),
    ):
        reference = price_sketch.reference_over(daily, ["cat"], first, last)
        wanted = gold.REFERENCE_QUANTILES
        errors = price_sketch.rank_errors(rows, ["cat"], "price", reference, wanted)
        near = errors.select("cat", *((F.col(c) <= RANK_ERROR).alias(f"{c}_near") for c in wanted))
        parts.append(reference.join(near, "cat").select(
            "cat", F.lit(span).alias("span"), "n", F.round(F.col("mean") + 1e-7, 4).alias("mean"), "low", "high",
            *(f"{c}_near" for c in wanted)))
    return parts[0].unionByName(parts[1])
