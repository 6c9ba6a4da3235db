"""What keeps tables of any size out of the driver and of single tasks: shapes of plans, and results on odd rows."""

from datetime import date

from conftest import DATA

from garimpo.operators import history, nested, notices, reports
from garimpo.plans import catalog
from garimpo.plans.registry import Tables
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_coverage_expands_days_not_ids(spark):
    rows = [(None, "a"), (None, None), (date(2020, 1, 1), "a"), (date(2020, 1, 1), "a"), (date(2020, 1, 2), "a"),
            (date(2020, 2, 1), "a"), (date(2020, 2, 1), None), (date(2021, 1, 1), "a"), (date(2021, 1, 1), "b")]
    df = spark.createDataFrame(rows, "d date, id string")
    found = reports.coverage(df, F.col("d"), F.col("id"), detailed=True)
    plan = _plan(found)
    assert "Window" in plan[plan.index("Expand"):]
    got = {(r.grain, r.year, r.year_month, r.day): (r.records, r.unique_ids) for r in found.collect()}
    assert got[("total", None, None, None)] == (9, 2)
    assert got[("year", None, None, None)] == (2, 1)
    assert got[("year", 2020, None, None)] == (5, 1)
    assert got[("month", 2020, "2020-01", None)] == (3, 1)
    assert got[("day", 2020, "2020-02", "2020-02-01")] == (2, 1)
    assert got[("day", 2021, "2021-01", "2021-01-01")] == (2, 2)


def test_labels_of_children_send_no_keys_to_every_task(spark):
    tables = Tables(spark, DATA)
    plan = _plan(catalog.REGISTRY["item_frequencies"].plan(tables))
    assert plan.count("SortMergeJoin") >= 2


def test_children_without_key_or_parent_are_not_counted(spark):
    parents = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int")
    children = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), (None, 1, "x"), ("c", 3, "y")], "k string, n int, label string")
    found = nested.child_labels(parents, ["k", "n"], children, ["label"]).collect()
    assert [(r.label, r.n) for r in found] == [("x", 4)]


def test_sanctions_are_read_once_and_records_kept(spark):
    rows = [(1, "a", date(2020, 1, 5)), (2, "a", date(2020, 1, 9)), (3, None, date(2020, 1, 5)), (4, "a", None), (2, "a", date(2020, 1, 9))]
    records = spark.createDataFrame(rows, "id int, c string, d date")
    held = [("a", date(2020, 1, 1), date(2020, 1, 5)), ("a", date(2020, 1, 9), date(2020, 1, 2)), (None, date(2020, 1, 1), None)]
    sanctions = spark.createDataFrame(held, "c string, s date, e date")
    found = history.active_at(records, "c", "d", sanctions, "s", "e", "hit")
    assert _plan(found).count("Generate explode") == 1
    assert sorted((r.id, r.hit) for r in found.collect()) == [(1, True), (2, False), (2, False), (3, False), (4, False)]


def test_words_are_counted_where_their_text_lies(spark):
    rows = [(1, "a b a"), (1, "b"), (2, "c"), (None, "a"), (3, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {(r.id, r.term): r.tf for r in notices.tf_idf(df, "id", "text").collect()}
    assert got == {(1, "a"): 2, (1, "b"): 2, (2, "c"): 1, (None, "a"): 1}
