"""Plan-shape guards: no cross joins anywhere, one shuffle for the features."""

import pytest

from stockroute.plans import catalog, catalog_more  # noqa: F401

QUERIES = catalog.QUERIES

# run by tests/test_runner.py and tests/test_catalog.py
SKIP = {"M9_planning_run", "M9_run_contents", "A12_results_roundtrip", "I12_recursive_rule"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cross_joins(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_lag_features_shuffle_once(spark, sf_small):
    plan = _plan(QUERIES["I5_lag_features"](spark, sf_small))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window ") >= 1


def test_scan_is_pruned(spark, sf_small):
    plan = QUERIES["K2_nearest_depot"](spark, sf_small)._jdf.queryExecution() \
        .executedPlan().toString()
    # only the two lineitem columns the stop view needs are read
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan \
        or "struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
