"""Physical-plan properties the scale design relies on (checked on sf0.001)."""

import pytest

from conftest import SF001
from barline.plans.catalog import QUERIES


def _plan(df) -> str:
    df.collect()  # the frame itself runs, so its plan is the final one
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_feature_table_two_exchanges_hash_aggregates(spark):
    p = _plan(QUERIES["feature_table"](spark, SF001))
    shuffles = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(shuffles) == 2, p
    assert "SortAggregate" not in p
    assert "Pandas" not in p and "Python" not in p and "Join" not in p


@pytest.mark.parametrize("key", ["tail_n", "latest_run_metrics"])
def test_top_k_is_limited_before_the_shuffle(spark, key):
    assert "WindowGroupLimit" in _plan(QUERIES[key](spark, SF001))


def test_serving_list_is_broadcast(spark):
    p = _plan(QUERIES["batch_predict"](spark, SF001))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in {
    "stacked_fit", "batch_score", "live_score", "next_forecast", "model_store", "hyperparam_search",
    "param_override", "stream_daily_close", "stream_live_score", "stream_live_score_l1", "csv_roundtrip", "batch_predict_values"}))
def test_no_cartesian_or_nested_loop_joins(spark, key):
    p = QUERIES[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", ["champion_promotion", "daily_resample", "dq_checks", "forecast_metrics"])
def test_aggregations_are_hash_aggregates(spark, key):
    p = _plan(QUERIES[key](spark, SF001))
    assert "SortAggregate" not in p, p


def test_clean_numeric_scans_only_the_needed_columns(spark):
    p = _plan(QUERIES["clean_numeric"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p, p
