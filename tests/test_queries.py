"""Every registered query: its plan, and its rows against its SQL answer."""

import re

import pytest

import __spark_entry__ as entry
from stockyard.plans import catalog, oracles
from tests.oracle import compare, connect

QUERIES, SQL = catalog.queries(), oracles.oracle_sql()
# these window over a handful of rows: statuses, calendar days
FEW_ROWS = {"sla_distribution", "pending_alarm"}
# nothing to find in the smallest tables
NO_ROWS = {"pending_alarm"}


def check_plan(name, df):
    """No cross join, no row-wise Python, and rows only meet in one task as partial aggregates, one per task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert banned not in plan
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        if "Exchange SinglePartition" in line and name not in FEW_ROWS:
            assert re.search(r"HashAggregate\(keys=\[\], functions=\[(\]|partial_|merge_)", below), below


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con(root):
    return connect(root)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, root, name):
    df = QUERIES[name](spark, root)
    check_plan(name, df)
    difference = compare(df, con, SQL[name])
    assert difference == ("no rows" if name in NO_ROWS else None)


def test_entry(spark):
    assert entry.entry(spark).columns == ["sla_status", "orders", "pct"]
