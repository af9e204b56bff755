"""The registered training-data queries against their SQL, where SQL can express them."""

import pytest

import oracle
from tidewatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, con, name):
    assert oracle.differences(con, QUERIES[name](spark, sf_dir), ORACLES[name]) is None


def test_all_are_there():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_product(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_syncmers_stay_in_the_jvm(spark, sf_dir):
    plan = QUERIES["op6_closed_syncmers"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
