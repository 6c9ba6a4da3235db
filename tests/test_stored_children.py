"""Children in buckets: same records as from loose children, and no child row exchanged."""

import random
from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from garimpo.operators import nested
from garimpo.operators.stored_children import StoredChildren, buckets_for, enrich_from_stored
from garimpo.plans import incremental, reporting
from garimpo.plans.registry import Tables
from garimpo.plans.shapes import records as shaped

KEYS = ["cnpj", "ano"]
CHILD = "cnpj string, ano int, n int, `a b` string"


def _exchanges_above_scans(plan: str, table: str) -> list[str]:
    """Exchanges on the way from a table's scan to the first join above it, from an indented plan."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "Scan" not in line or table not in line:
            continue
        depth = next(j for j, c in enumerate(line) if c.isalpha() or c == "*")
        for above in reversed(lines[:i]):
            at = next((j for j, c in enumerate(above) if c.isalpha() or c == "*"), 0)
            if at >= depth:
                continue
            depth = at
            if "Join" in above:
                break
            if "Exchange" in above:
                found.append(above)
    return found


def _stored(spark, folder, rows, buckets=4):
    made = spark.createDataFrame(rows, CHILD)
    return StoredChildren(spark, folder, made.schema, KEYS, ["n"], buckets).append(made)


def test_same_records_as_from_loose_children(spark, folder):
    rng = random.Random(4)
    keys = [("1", 2024), ("2", 2024), ("2", 2023), ("hot", 2024), (None, 2024), ("", 2024), ("none", 2020)]
    rows = [(*(rng.choice(keys[:6]) if rng.random() < 0.6 else keys[3]), rng.randrange(9), rng.choice("xyz")) for _ in range(500)]
    heads = spark.createDataFrame(keys, "cnpj string, ano int")
    failed = spark.createDataFrame([("2", 2023, "timeout")], "cnpj string, ano int, error string")
    loose = spark.createDataFrame(rows, CHILD)
    items, files = _stored(spark, f"{folder}/it's", rows[:250]), _stored(spark, f"{folder}/files", rows)
    items.append(spark.createDataFrame(rows[250:], CHILD).select("`a b`", "n", "cnpj", "ano"))

    def plain(df):
        return sorted(repr((r.cnpj, r.ano, r.itens, r.arquivos, r.metadata.total_itens, r.metadata.fetch_error)) for r in df.collect())

    assert plain(enrich_from_stored(heads, items, files, failed)) == plain(
        nested.enrich(heads, KEYS, loose, loose, ["n"], ["n"], failed))
    assert items.rows().where("cnpj is null").count() == 0
    # Another session opens the folder by the same arguments.
    again = StoredChildren(spark, f"{folder}/it's", items.schema, KEYS, ["n"], 4)
    assert again.rows().count() == items.rows().count() == sum(r[0] is not None for r in rows)


def test_no_child_is_exchanged(spark):
    t = Tables(spark, DATA)
    items, files = incremental._stored(t)
    out = reporting.told(enrich_from_stored(shaped(t), items, files, reporting.failed_reads(t)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    for stored in (items, files):
        assert stored.table in plan
        assert _exchanges_above_scans(plan, stored.table) == []
    loose = nested.child_lists(t.lineitem, ["l_orderkey"], ["l_linenumber"], "itens")
    joined = t.orders.join(loose, F.col("l_orderkey") == F.col("o_orderkey"))
    assert _exchanges_above_scans(joined._jdf.queryExecution().executedPlan().toString(), "l_orderkey") != []


def test_a_bucket_is_one_file_unless_it_is_large(spark, folder, tmp_path):
    rows = [(str(i % 50), 2024, i, "x") for i in range(1000)]
    _stored(spark, folder, rows, buckets=8)
    files = [p.name for p in Path(tmp_path).glob("*.parquet")]
    buckets = {f.rsplit("_", 1)[1].split(".")[0] for f in files}
    assert len(files) == len(buckets) <= 8


def test_unlike_tables_are_refused(spark, folder):
    one, two = _stored(spark, f"{folder}/1", [], 4), _stored(spark, f"{folder}/2", [], 8)
    heads = spark.createDataFrame([("1", 2024)], "cnpj string, ano int")
    with pytest.raises(ValueError):
        enrich_from_stored(heads, one, two)
    with pytest.raises(TypeError):
        enrich_from_stored(heads.withColumn("ano", F.col("ano").cast("long")), one, one)
    assert enrich_from_stored(heads, one, one).first().itens == []
    assert buckets_for(spark, 0) == 4 and buckets_for(spark, 10 << 30, 1 << 30) == 10
