"""Every registered query against its SQL oracle on the smallest tables, and its plan's shape."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

PATH = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()
#: Assertions that nothing in the smallest tables breaks.
NOTHING_FOUND = {"assert_expression_between", "assert_min_between"}


@pytest.fixture(scope="module")
def duck():
    return connect(PATH)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, PATH)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    problem = compare(df, duck, ORACLES[name]) if name in ORACLES else None
    assert problem == ("EMPTY" if name in NOTHING_FOUND else None)


def test_entry_runs(spark):
    assert entry(spark).count() > 0
