"""Sketches per day: exact counts, ranks within the stated error, new days without touching old ones."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from garimpo.operators import price_sketch
from garimpo.operators.gold import REFERENCE_QUANTILES

SCHEMA = "cat string, d date, price double"


def _rows(n=12000):
    rng = random.Random(8)
    return [(rng.choice("aaab"), date(2024, 1, 1) + timedelta(days=rng.randrange(20)), rng.lognormvariate(5, 1)) for _ in range(n)]


def test_ranges_of_days(spark, folder):
    df = spark.createDataFrame(_rows(), SCHEMA)
    price_sketch.daily_references(df, ["cat"], "d", "price").write.parquet(f"{folder}/daily")
    daily = spark.read.parquet(f"{folder}/daily")
    for first, last in ((None, None), ("2024-01-05", "2024-01-12"), (None, "2024-01-01"), ("2024-01-20", None)):
        ends = [None if x is None else F.lit(x).cast("date") for x in (first, last)]
        kept = df.where(F.lit(True) if first is None else F.col("d") >= first).where(F.lit(True) if last is None else F.col("d") <= last)
        reference = price_sketch.reference_over(daily, ["cat"], *ends)
        exact = {r.cat: r for r in kept.groupBy("cat").agg(
            F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"), F.avg("price").alias("mean")).collect()}
        for r in reference.collect():
            e = exact.pop(r.cat)
            assert (r.n, r.low, r.high) == (e.n, e.low, e.high) and abs(r["mean"] - e["mean"]) < 1e-6
        assert not exact
        errors = price_sketch.rank_errors(kept, ["cat"], "price", reference, REFERENCE_QUANTILES).collect()
        assert len(errors) == 2 and max(max(r[c] for c in REFERENCE_QUANTILES) for r in errors) < 0.02


def test_a_new_day_is_added_as_rows_of_its_own(spark):
    rows = _rows(2000)
    old = spark.createDataFrame([r for r in rows if r[1] < date(2024, 1, 15)], SCHEMA)
    new = spark.createDataFrame([r for r in rows if r[1] >= date(2024, 1, 15)], SCHEMA)
    both = price_sketch.daily_references(old, ["cat"], "d", "price").unionByName(price_sketch.daily_references(new, ["cat"], "d", "price"))
    got = {r.cat: r.n for r in price_sketch.reference_over(both, ["cat"]).collect()}
    assert got == {c: sum(r[0] == c for r in rows) for c in "ab"}


def test_nulls_nan_and_no_rows(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame([("a", day, None), ("a", day, float("nan")), ("a", day, 3.0), ("b", day, None), (None, day, 2.0)], SCHEMA)
    got = {r.cat: (r.n, r.median) for r in price_sketch.reference_over(
        price_sketch.daily_references(df, ["cat"], "d", "price"), ["cat"], wanted={"median": 0.5}).collect()}
    assert got == {"a": (1, 3.0), None: (1, 2.0)}
    assert price_sketch.reference_over(price_sketch.daily_references(df.limit(0), ["cat"], "d", "price"), ["cat"]).count() == 0
