"""Every registered query against the same result in SQL."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql
from gaugelake.entry.queries import registered as queries

SF_DIR = "/root/testdata/sf0.001"
# all pairs of two tables, and rows that leave the JVM
UNWANTED = ["CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "InPandas"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) <= set(oracle_sql())


def test_entry(spark):
    assert len(entry(spark).collect()) == 10


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert compare(result, duck, oracle_sql()[name]) is None
