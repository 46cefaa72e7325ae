"""Every registered query that has a check equals it (columns, types and values), without Python or cross joins."""

import pytest

from fablens.plans import ORACLES, QUERIES
from tests import oracle


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


SLOW_OPERATORS = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [o for o in SLOW_OPERATORS if o in plan] == []
    assert oracle.differences(df, con, ORACLES[name]) == ""


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
