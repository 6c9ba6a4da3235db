"""Price references, features, labels, splits, profiles, risk rules and record queries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.domains import literal_table
from garimpo.operators.running import join_groups, percent_ranks, quantiles, written_ranks

# ---------------------------------------------------------------------------
# States by region, government spheres.
# ---------------------------------------------------------------------------
REGIONS = """
Norte AC AM AP PA RO RR TO
Nordeste AL BA CE MA PB PE PI RN SE
Centro-Oeste DF GO MS MT
Sudeste ES MG RJ SP
Sul PR RS SC
"""
SPHERES = {"F": "Federal", "E": "Estadual", "M": "Municipal", "D": "Distrital"}
# Our bands for the risk score; the score itself lies in [0, 1].
SEVERITY = ((0.8, "critical"), (0.6, "high"), (0.3, "medium"))
SUSPICIOUS_ABOVE = 0.8
# ---------------------------------------------------------------------------

REFERENCE_QUANTILES = {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95}


def price_reference(
    df: DataFrame, keys: Sequence[str], value: str, at: str, marketplace: str,
    wanted: dict[str, float] = REFERENCE_QUANTILES,
) -> DataFrame:
    """Mean, exact quantiles, deviation, count, date span and marketplaces per group.

    ``wanted`` names the quantiles; ask only for what is used. Marketplaces are a short list of sites.
    """
    base = df.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"),
        F.min(at).alias("first_date"), F.max(at).alias("last_date"),
        F.sort_array(F.collect_set(marketplace)).alias("marketplaces"),
    )
    return join_groups(base, quantiles(df, keys, value, wanted), keys)


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in columns))


def price_features(
    df: DataFrame, category: str, value: str, market: DataFrame, buyer_mean: str
) -> DataFrame:
    """Log value, ratios to category and market, z-score, percent rank, deviation from the buyer's past.

    ``market`` is a price reference by the same category; ``buyer_mean`` holds the buyer's mean
    over earlier records.
    """
    own = df.groupBy(category).agg(F.avg(value).alias("__mean"), F.stddev_samp(value).alias("__sd"))
    # The median and the percent ranks come from one pass over the sorted values.
    ranks = written_ranks(df, [category], value)
    own = join_groups(own, quantiles(df, [category], value, {"__median": 0.5}, ranks), [category])
    ranked = percent_ranks(df, [category], value, "percentile_preco", ranks)
    joined = join_groups(ranked, own, [category])
    joined = join_groups(joined, _prefixed(market, [category], "__market_", ["mean", "p95"]), [category])
    v = F.col(value)
    return joined.select(
        *df.columns, "percentile_preco",
        F.when(v > 0, F.log(v)).alias("log_valor_total"),
        F.try_divide(v, F.col("__mean")).alias("preco_vs_media_categoria"),
        F.try_divide(v, F.col("__median")).alias("preco_vs_mediana_categoria"),
        F.try_divide(v - F.col("__mean"), F.col("__sd")).alias("zscore_preco"),
        F.try_divide(v, F.col("__market_mean")).alias("preco_vs_mercado"),
        F.try_divide(v, F.col("__market_p95")).alias("preco_vs_p95_mercado"),
        F.try_divide(v - F.col(buyer_mean), F.col(buyer_mean)).alias("desvio_preco_historico_orgao"),
    )


def temporal_features(df: DataFrame, opened: str, durations: dict[str, tuple[str, str]]) -> DataFrame:
    """Weekday (Sunday is 1), month, quarter, year and durations in days."""
    return df.withColumns({
        "dia_semana": F.dayofweek(opened), "mes": F.month(opened), "trimestre": F.quarter(opened),
        "ano": F.year(opened), **{n: F.datediff(last, first) for n, (first, last) in durations.items()},
    })


def region_table(df: DataFrame) -> DataFrame:
    rows = [(uf, line.split()[0]) for line in REGIONS.strip().splitlines() for uf in line.split()[1:]]
    return literal_table(df.sparkSession, rows, "uf", "regiao")


def encode_place(df: DataFrame, sphere: str, state: str) -> DataFrame:
    """Sphere name and region of a record; unknown codes give null. The state list has 27 rows."""
    named = F.lit(None)
    for code, name in SPHERES.items():
        named = F.when(F.col(sphere) == code, name).otherwise(named)
    joined = df.join(F.broadcast(region_table(df)), F.col(state) == F.col("uf"), "left")
    return joined.drop("uf").withColumn("esfera", named)


def interaction(df: DataFrame, parts: Sequence[str], name: str = "interaction") -> DataFrame:
    """Counts per combined key."""
    return df.groupBy(F.concat_ws("_", *parts).alias(name)).agg(F.count("*").alias("n"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in doubles. A whole of 0 gives infinity, or NaN for 0 / 0, as the SQL checks do; nulls stay null."""
    part, whole = part.cast("double"), whole.cast("double")
    by_zero = F.when(F.isnan(part) | (part == 0), F.lit(float("nan"))).otherwise(F.signum(part) * F.lit(float("inf")))
    return F.when(whole == 0, F.when(part.isNotNull(), by_zero)).otherwise(F.try_divide(part, whole))


def combined_score(rules: Column, llm: Column) -> Column:
    """0.7 rules + 0.3 model opinion."""
    return rules * 0.7 + llm * 0.3


def weak_label(sanctioned: Column, score: Column, price: Column, reference: Column) -> Column:
    """Suspicious when sanctioned, scored above 0.8, or dearer than twice the reference."""
    def sure(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return sure(sanctioned) | sure(score > SUSPICIOUS_ABOVE) | sure(price > reference * 2)


def hash_split(ident: Column, train: int = 70, validation: int = 15) -> Column:
    """Split name by a hash of the id: the same id always lands in the same split."""
    bucket = F.pmod(F.conv(F.substring(F.md5(ident.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(bucket < train, "train").when(bucket < train + validation, "validation").otherwise("test")


def temporal_split(at: Column, validation_from: str, test_from: str) -> Column:
    day = F.to_date(at)
    return F.when(day < F.lit(validation_from).cast("date"), "train").when(
        day < F.lit(test_from).cast("date"), "validation").otherwise("test")


def class_balance(df: DataFrame, split: Column, label: Column) -> DataFrame:
    """Rows per split and label with their share of the split."""
    counts = df.groupBy(split.alias("split"), label.alias("label")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("split").agg(F.sum("n").alias("__total"))
    return counts.join(totals, "split").withColumn("share", F.col("n") / F.col("__total")).drop("__total")


def severity(score: Column) -> Column:
    band = F.lit("low")
    for limit, name in reversed(SEVERITY):
        band = F.when(score >= limit, name).otherwise(band)
    return F.when(score.isNotNull(), band)


def record_query(
    df: DataFrame, score: str, ident: str, minimum: float | None = None, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Records above a score, best first, ties by id, one page of them."""
    found = df if minimum is None else df.where(F.col(score) >= minimum)
    page = found.orderBy(F.desc(score), ident)
    page = page.offset(offset) if offset else page
    return page if limit is None else page.limit(limit)


def explain_queue(df: DataFrame, day: str, score: str, ident: str, top: int = 20) -> DataFrame:
    """The highest suspicious records of each day, with their rank."""
    first = Window.partitionBy(day).orderBy(F.desc(score), ident)
    ranked = df.where(F.col(score) > SUSPICIOUS_ABOVE).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= top)


def score_stats(df: DataFrame, by: Sequence[str | Column], score: str, value: Column) -> DataFrame:
    """Records, value, mean score and share of suspicious records per group."""
    flags = F.sum((F.col(score) > SUSPICIOUS_ABOVE).cast("long"))
    return df.groupBy(*by).agg(
        F.count("*").alias("records"), F.sum(value).cast("double").alias("total_value"),
        F.avg(F.col(score).cast("decimal(9,4)")).cast("double").alias("mean_score"),
        flags.alias("suspicious"), (flags / F.count("*")).alias("share_suspicious"),
    )


def reference_coverage(df: DataFrame, category: str, reference: DataFrame, price: str) -> DataFrame:
    """Per category the share of records that have a reference price."""
    counts = df.groupBy(category).agg(F.count("*").alias("records"))
    known = reference.where(F.col(price).isNotNull()).select(F.col(category).alias("__c")).distinct()
    joined = counts.join(known, F.col(category) == F.col("__c"), "left")
    covered = F.when(F.col("__c").isNotNull(), F.col("records")).otherwise(0)
    return joined.select(category, "records", covered.alias("covered"), (covered / F.col("records")).alias("coverage"))


def profile(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, nulls, distinct values, extremes, mean, deviation and quartiles per group."""
    base = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.sum(F.col(value).isNull().cast("long")).alias("nulls"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
    )
    ranked = quantiles(df, keys, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, distinct="distinct_values")
    return join_groups(base, ranked, keys).fillna(0, ["distinct_values"])


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same profile with one row per numeric column."""
    wide = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    long = wide.unpivot([], list(columns), "column", "value")
    return profile(long, ["column"], "value")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, computed in one pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    entries = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
               for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*entries)))


def seasonality(df: DataFrame, at: str, value: Column, unit: str = "month") -> DataFrame:
    """Totals per month or quarter and their change against the same period a year before."""
    totals = df.groupBy(F.to_date(F.date_trunc(unit, at)).alias("period")).agg(
        F.count("*").alias("records"), F.sum(value).alias("__total"))
    before = totals.select(F.add_months("period", 12).alias("period"), F.col("__total").alias("__before"))
    joined = totals.join(before, "period", "left")
    now, past = F.col("__total").cast("double"), F.col("__before").cast("double")
    return joined.select("period", "records", now.alias("total"), F.try_divide(now - past, past).alias("change_yoy"))


def per_inhabitant(df: DataFrame, place: str, value: Column, population: DataFrame, inhabitants: str) -> DataFrame:
    """Value per inhabitant; places without a population give null."""
    people = population.select(F.col(place).alias("__place"), F.col(inhabitants).alias("__people"))
    joined = df.join(people, F.col(place) == F.col("__place"), "left")
    return joined.select(*df.columns, F.try_divide(value, F.col("__people")).alias("valor_por_habitante"))


def overprice(df: DataFrame, category: str, value: str, factor: float, name: str) -> DataFrame:
    """Whether the value exceeds ``factor`` times the category median."""
    medians = quantiles(df, [category], value, {"__median": 0.5})
    joined = join_groups(df, medians, [category])
    flag = F.coalesce(F.col(value) > F.col("__median") * factor, F.lit(False))
    return joined.select(*df.columns, flag.alias(name))


def total_mismatch(
    df: DataFrame, ident: str, total: Column, items: DataFrame, item_ident: str, item_value: Column,
    tolerance: float, name: str,
) -> DataFrame:
    """Whether the stated total differs from the sum of the items by more than the tolerance."""
    sums = items.groupBy(F.col(item_ident).alias("__id")).agg(F.sum(item_value).alias("__sum"))
    joined = df.join(sums, F.col(ident) == F.col("__id"), "left")
    gap = F.abs(total - F.coalesce("__sum", F.lit(0)))
    return joined.select(*df.columns, (gap > F.lit(tolerance)).alias(name))


def quality_checks(df: DataFrame, rules: dict[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """One row per check with its violations, from a single aggregate over the rows.

    ``rules`` are conditions every row must meet; an unknown result counts as a violation.
    ``unique`` columns must not repeat.
    """
    broken = {n: F.sum((~F.coalesce(ok, F.lit(False))).cast("long")) for n, ok in rules.items()}
    broken |= {f"unique_{c}": F.count(c) - F.countDistinct(c) for c in unique}
    names = list(broken)
    row = df.agg(F.count("*").alias("__rows"), *(F.coalesce(broken[n], F.lit(0)).alias(n) for n in names))
    entries = [F.struct(F.lit(n).alias("check"), F.col("__rows").alias("rows"), F.col(n).alias("violations")) for n in names]
    return row.select(F.inline(F.array(*entries))).withColumn("passed", F.col("violations") == 0)


def with_reference(df: DataFrame, key: str, target: DataFrame, target_key: str, name: str) -> DataFrame:
    """Add whether the key exists in another table, for referential checks."""
    keys = target.select(F.col(target_key).alias("__ref")).distinct()
    joined = df.join(keys, F.col(key) == F.col("__ref"), "left")
    return joined.withColumn(name, F.col("__ref").isNotNull()).drop("__ref")
