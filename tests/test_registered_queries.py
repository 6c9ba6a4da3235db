"""Every registered query against its SQL in DuckDB, and rules its plan must keep."""

import pytest
from conftest import DATA
from oracle import compare, duck

from garimpo.plans import catalog
from garimpo.plans.registry import Tables

NAMES = sorted(catalog.REGISTRY)
# May be empty on the smallest tables.
MAY_BE_EMPTY = {"record_page", "explain_queue"}
# Plans that write and read back; their explain would run the writes a second time.
WRITERS = {n for n, q in catalog.REGISTRY.items() if q.plan.__module__.endswith((".lake", ".incremental"))}


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    query = catalog.REGISTRY[name]
    assert query.sql is not None
    error = compare(query.plan(Tables(spark, DATA)), con, query.sql)
    if name in MAY_BE_EMPTY and error == "no rows on both sides":
        error = None
    assert error is None


@pytest.mark.parametrize("name", [n for n in NAMES if n not in WRITERS])
def test_no_pairwise_join(spark, name):
    plan = catalog.REGISTRY[name].plan(Tables(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
