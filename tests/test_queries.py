"""Every registered query: equal to its SQL on a second engine, or at least running with rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import differences

QUERIES, SQL = queries(), oracle_sql()


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_second_engine(spark, small, no_broadcast, name):
    """Planned as for large tables, which must not lead to a cross join or to Python workers."""
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
        assert slow not in plan
    assert differences(df, SQL[name], small) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
