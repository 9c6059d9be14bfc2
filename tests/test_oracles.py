"""Every registered query against its SQL, on the smallest tables."""

import pytest

from klinark.plans.registry import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, connection, name):
    frame = QUERIES[name](spark, folder)
    shown = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in shown]
    assert compare(frame, connection, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
