from __future__ import annotations

import pytest
from oracle import compare, connect
from strata.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, sf_dir).count() >= 0
        return
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


# Queries that write a text or stream folder read it back in plain scans, like all others.
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_python_in_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "CartesianProduct"):
        assert word not in plan
