"""Histories fed by stretches of days against one run over all days, with one key holding most rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from garimpo.operators import history
from garimpo.operators.carried import CarriedHistory, OutOfOrder
from garimpo.operators.commits import Conflict
from garimpo.operators.running import range_bucket

SCHEMA = "id int, k string, v decimal(15,2), flag boolean, d date, e date"
START = date(2024, 1, 30)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(400):
        day = START + timedelta(days=rng.randrange(60))
        end = rng.choice([None, day + timedelta(days=rng.randrange(0, 90)), day - timedelta(days=3)])
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        out.append((i, key, rng.randrange(1, 9999), rng.random() < 0.4, day, end))
    return out


def company(df, totals=None):
    more = () if totals is None else (totals,)
    return history.company_history(df, "k", "d", "id", F.col("v"), F.col("flag"), "e", *more)


def buyer(df, totals=None):
    more = () if totals is None else (totals,)
    return history.buyer_history(df, "k", ["d", "id"], "d", F.col("v"), F.col("flag"), *more)


def encoding(df, totals=None):
    more = {} if totals is None else {"totals": totals}
    label, parts = F.col("flag").cast("int"), range_bucket(F.col("id"), 100)
    return history.target_encoding(df.where("k is not null"), "k", ["d", "id"], "d", label, "enc", parts, **more)


def overlaps(df, totals=None):
    more = () if totals is None else (totals,)
    return history.overlaps_earlier(df.where("k is not null"), ["k"], "d", "e", "id", "hit", *more)


def plain(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, v int, flag boolean, d date, e date").withColumn("v", F.col("v").cast("decimal(15,2)"))


@pytest.mark.parametrize("known,cuts,fold_every", [
    (company, [1, 2, 20, 45, 60], 2), (company, [30, 60], 32), (buyer, [7, 8, 60], 2), (encoding, [10, 60], 32), (overlaps, [15, 31, 60], 3)])
def test_stretches_equal_one_run(spark, folder, rows, known, cuts, fold_every):
    df = frame(spark, rows)
    table = CarriedHistory(spark, folder, "h", fold_every=fold_every)
    after = 0
    for cut in cuts:
        part = [r for r in rows if after <= (r[4] - START).days < cut]
        assert table.feed(f"to-{cut}", frame(spark, part), "d", known)
        after = cut
    whole = known(df)
    got = table.read()
    assert set(got.columns) == {*whole.columns, "run"}
    columns = ["id", *(c for c in whole.columns if c not in df.columns)]
    assert repr(plain(got.select(columns), columns)) == repr(plain(whole.select(columns), columns))


def test_a_run_reads_state_and_the_months_it_covers(spark, folder, rows):
    table = CarriedHistory(spark, folder, "h")
    table.feed("one", frame(spark, [r for r in rows if (r[4] - START).days < 20]), "d", company)
    seen = {}

    def watched(batch, totals):
        out = company(batch, totals)
        seen["files"], seen["plan"] = out.inputFiles(), out._jdf.queryExecution().executedPlan().toString()
        return out

    table.feed("two", frame(spark, [r for r in rows if (r[4] - START).days == 25]), "d", watched)
    assert not any("/rows/" in f for f in seen["files"]) and any("/totals-0-k/run=one" in f for f in seen["files"])
    months = [x.partition("PartitionFilters: [")[2] for x in seen["plan"].splitlines() if "FileScan" in x and ",due#" in x]
    assert months and all(">= 2024-02" in x and "<= 2024-02" in x for x in months)


def test_order_repeats_and_a_second_writer(spark, folder, rows):
    table = CarriedHistory(spark, folder, "h")
    assert table.closed() is None and table.read() is None
    early = frame(spark, [r for r in rows if (r[4] - START).days < 5])
    assert table.feed("one", early, "d", buyer)
    n = table.read().count()
    assert not table.feed("one", early, "d", buyer) and table.read().count() == n
    with pytest.raises(OutOfOrder):
        table.feed("late", early, "d", buyer)
    with pytest.raises(OutOfOrder):
        table.feed("undated", early.withColumn("d", F.lit(None).cast("date")), "d", buyer)
    with pytest.raises(OutOfOrder):
        table.feed("beyond", frame(spark, rows[:1]).withColumn("d", F.lit("2025-01-01").cast("date")), "d", buyer, upto=date(2024, 12, 1))
    assert table.feed("empty", early.limit(0), "d", buyer) and table.read().count() == n

    def overtaken(batch, totals):
        out = buyer(batch, totals)
        CarriedHistory(spark, folder, "h").feed("other", batch, "d", buyer)
        return out

    later = frame(spark, [r for r in rows if (r[4] - START).days == 9])
    with pytest.raises(Conflict):
        table.feed("mine", later, "d", overtaken)
    assert table.read().where("run = 'mine'").count() == 0
    closed = CarriedHistory(spark, folder, "h").closed()
    assert table.feed("quiet", early.limit(0), "d", buyer, upto=closed + timedelta(days=30))
    assert table.closed() == closed + timedelta(days=30)
