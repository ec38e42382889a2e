"""Every registered query against its SQL, and no plan with a cross product."""

import pytest

import oracle
from meterlake.plans.catalog import load_all

ENTRIES = load_all()


@pytest.fixture(scope="module")
def db(folder):
    return oracle.database(folder)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, db, folder, name):
    entry = ENTRIES[name]
    df = entry.run(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ok, message = oracle.compare(spark, db, folder, lambda *_: df, entry.sql)
    assert ok, message


def test_entry_file(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["date", "total_cost"]
