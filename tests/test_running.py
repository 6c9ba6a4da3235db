"""Bucketed totals, ranks and histories against plain Python, with one key holding most rows."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from garimpo.operators import gold, history, running, similar
from garimpo.operators.notices import tf_idf


def _skewed(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        rows.append((i, key, rng.choice([0.0, -3.5, 1e6, round(rng.lognormvariate(3, 2), 2)]), rng.random() < 0.3,
                     date(2024, 1, 1) + timedelta(days=rng.randrange(40))))
    return rows


SCHEMA = "id int, k string, v double, flag boolean, d date"


@pytest.fixture(scope="module")
def rows():
    return _skewed()


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_totals_before(spark, rows, width):
    df = spark.createDataFrame(rows, SCHEMA).where("k is not null")
    got = running.totals_before(
        df, ["k"], ["id"], {"n": ("count", F.lit(1)), "s": ("sum", F.col("id")), "m": ("max", F.col("d")),
                            "lo": ("min", F.col("d"))}, running.range_bucket(F.col("id"), width), {"all_n": "n"}).collect()
    for r in got:
        before = [x for x in rows if x[1] == r.k and x[0] < r.id]
        assert r.n == len(before) and r.s == sum(x[0] for x in before)
        assert r.m == max((x[4] for x in before), default=None) and r.lo == min((x[4] for x in before), default=None)
        assert r.all_n == len([x for x in rows if x[1] == r.k])
    assert len(got) == df.count()


def test_position(spark):
    df = spark.range(0, 1000, 7)
    got = [r.p for r in running.position(df, "id", "p", width=50).orderBy("id").collect()]
    assert got == list(range(len(got)))


def test_quantiles_and_ranks_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    probs = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    got = {r.k: r for r in running.quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == {"hot", "a", "b", None}
    for key, row in got.items():
        values = [x[2] for x in rows if x[1] == key]
        for name, p in probs.items():
            assert row[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    for r in running.percent_ranks(df, ["k"], "v", "pr").collect():
        values = [x[2] for x in rows if x[1] == r.k]
        assert r.pr == pytest.approx(sum(v < r.v for v in values) / (len(values) - 1))


def test_magnitude_bucket_is_monotone(spark):
    values = sorted([0.0, -0.0, 1e-9, -1e-9, 1.0, 1.0000001, 2.0, -2.0, 1e300, -1e300, 7.5, 7.51])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    buckets = [r.b for r in df.select("i", running.magnitude_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert buckets == sorted(buckets)


def test_magnitude_bucket_spreads_shares_and_puts_nan_on_top(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("v")).unionAll(
        spark.sql("SELECT double('NaN') UNION ALL SELECT double('Infinity') UNION ALL SELECT 5e-324"))
    rows = df.select("v", running.magnitude_bucket(F.col("v")).alias("b")).collect()
    assert len({r.b for r in rows}) > 300
    assert max(rows, key=lambda r: r.b).v != max(rows, key=lambda r: r.b).v


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([("k", v) for v in (1.0, 5.0, float("nan"))], "k string, v double")
    assert running.quantiles(df, ["k"], "v", {"m": 0.5}).first().m == 5.0
    ranks = {str(r.v): r.pr for r in running.percent_ranks(df, ["k"], "v", "pr").collect()}
    assert ranks == {"1.0": 0.0, "5.0": 0.5, "nan": 1.0}


def test_inverted_intervals_take_nothing_away(spark):
    day = date(2024, 1, 10)
    df = spark.createDataFrame([(1, "a", day)], "id long, k string, d date")
    listed = [("a", date(2024, 1, 1), date(2024, 1, 31)), ("a", date(2024, 1, 9), date(2024, 1, 5)), ("a", None, date(2024, 1, 5))]
    sanctions = spark.createDataFrame(listed, "k string, s date, e date")
    assert history.active_at(df, "k", "d", sanctions, "s", "e", "hit").first().hit is True
    rows = [(1, "a", date(2024, 1, 5), date(2024, 1, 1)), (2, "a", day, None)]
    both = spark.createDataFrame(rows, "id long, k string, d date, e date")
    out = history.company_history(both, "k", "d", "id", F.lit(1), F.lit(True), "e").collect()
    assert {r.id: r.active_contracts for r in out} == {1: 0, 2: 0}


def test_totals_before_in_two_levels(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("k"))
    got = running.totals_before(df, ["k"], ["id"], {"n": ("count", F.lit(1)), "s": ("sum", F.col("id"))}, F.col("id"), {"all_n": "n"})
    for r in got.collect():
        past = range(r.k, r.id, 2)
        assert (r.n, r.s, r.all_n) == (len(past), sum(past), 2500)


def test_sanctions_and_history(spark, rows):
    df = spark.createDataFrame([(*r, r[4] + timedelta(days=r[0] % 9) if r[0] % 5 else None) for r in rows], SCHEMA + ", e date")
    data = df.collect()
    sanctions = df.where("flag").select("k", F.col("d").alias("s"), "e")
    listed = sanctions.collect()
    for r in history.active_at(df, "k", "d", sanctions, "s", "e", "hit").collect():
        want = any(x.k == r.k and x.k is not None and x.s <= r.d and (x.e is None or r.d <= x.e) for x in listed)
        assert r.hit == want
    out = history.company_history(df, "k", "d", "id", F.col("id").cast("decimal(15,2)"), F.col("flag"), "e").collect()
    assert len(out) == len(data)
    for r in out:
        past = [x for x in data if r.k is not None and x.k == r.k and (x.d, x.id) < (r.d, r.id)]
        assert r.previous_count == len(past)
        if r.k is None:
            assert (r.previous_value, r.win_rate, r.active_contracts) == (None, None, 0)
            continue
        assert r.previous_value == sum(x.id for x in past)
        assert r.win_rate == (pytest.approx(sum(x.flag for x in past) / len(past)) if past else None)
        assert r.active_contracts == sum(x.e is None or x.e >= r.d for x in past)
        assert r.days_since_previous == ((r.d - max(x.d for x in past)).days if past else None)


def test_overlaps_and_encoding(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("e", F.date_add("d", F.col("id") % 6))
    data = df.collect()
    for r in history.overlaps_earlier(df, ["k"], "d", "e", "id", "hit").where("k is not null").collect():
        assert r.hit == any(x.k == r.k and (x.d, x.id) < (r.d, r.id) and x.e >= r.d for x in data)
    label = F.col("flag").cast("int")
    parts = running.range_bucket(F.col("id"), 100)
    for r in history.target_encoding(df.where("k is not null"), "k", ["d", "id"], "d", label, "enc", parts).collect():
        past = [x for x in data if x.k is not None and (x.d, x.id) < (r.d, r.id)]
        own = [x for x in past if x.k == r.k] or past
        assert r.enc == (pytest.approx(sum(x.flag for x in own) / len(own)) if own else None)


def test_similar_batch_is_exact_for_any_number_of_probes(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, v array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = similar.similar_batch(df, "id", "v", df.where("id < 3"), k=5).collect()
    for probe in range(3):
        sims = unit @ unit[probe]
        want = [i for i in np.argsort(-sims) if i != probe][:5]
        assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.probe == probe] == want
    # Any number of probes, in blocks of any size.
    for block in (7, 1000):
        every = similar.similar_batch(df, "id", "v", df, k=5, block=block).collect()
        assert len(every) == 300
        for probe in range(60):
            want = [i for i in np.argsort(-(unit @ unit[probe])) if i != probe][:5]
            assert [r.id for r in sorted(every, key=lambda r: r["rank"]) if r.probe == probe] == want


def test_tf_idf(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "a c"), (3, "")], "id int, t string")
    got = {(r.id, r.term): (r.tf, r.df, r.weight) for r in tf_idf(df, "id", "t").collect()}
    assert got[(1, "a")] == (2, 2, pytest.approx(2 * np.log(4 / 3)))
    assert got[(2, "c")] == (1, 1, pytest.approx(np.log(4 / 2)))
    assert len(got) == 4


def test_split_is_stable(spark):
    df = spark.range(5000).select(gold.hash_split(F.col("id")).alias("s")).groupBy("s").count()
    shares = {r.s: r["count"] / 5000 for r in df.collect()}
    assert shares["train"] == pytest.approx(0.7, abs=0.03) and shares["test"] == pytest.approx(0.15, abs=0.03)
