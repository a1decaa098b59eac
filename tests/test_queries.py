"""Every registered query against its SQL counterpart, and what its plan may not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cartwheel.registry import QUERIES
from tools.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_a_counterpart():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(con, name, df) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric_date", "dau", "view_count", "purchase_count",
                          "conversion_rate", "revenue", "event_count"]
    assert df.count() == 30
