"""Every query against its SQL on the smallest tables, and what its plan must not contain."""

import pytest

import __spark_entry__ as spark_entry
from oracles.catalog import SQL
from tallymart.catalog import QUERIES
from tests.compare import differences, duck

# Python workers and joins that compare every pair of rows.
UNWANTED = [
    "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(QUERIES) <= set(spark_entry.queries())


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in UNWANTED if word in plan] == []
    assert len(set(df.columns)) == len(df.columns)
    assert differences(df, con, SQL[name]) == []
