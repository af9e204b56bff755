"""Every registered query against its SQL check, and its plan against bad joins."""

import pytest

import oracle
from tidewatch.suite import REGISTRY


@pytest.mark.parametrize("key", list(REGISTRY))
def test_query(spark, sf_dir, con, key):
    q = REGISTRY[key]
    df = q.build(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if q.sql is None:
        assert df.count() > 0
    else:
        assert oracle.differences(con, df, q.sql) is None


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[0] == "bucket"
