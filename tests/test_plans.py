"""Plan shape: no Cartesian products or nested-loop joins anywhere; the
training-feature plan keeps two exchanges, one sort and pushed filters."""

import pytest

import __spark_entry__ as E
from ashgrid.catalog import QUERIES

from .conftest import SF0001

# model fits and multi-run jobs are left out: their plans are built inside fit() / runs
_SKIP = {"daily_scoring", "model_bakeoff", "feature_group_ab", "size_accuracy_sweep", "model_size", "refit_full",
         "model_save", "model_load", "score_table", "rf_classifier", "rf_regressor", "linear_regression", "ridge",
         "feature_importance", "assert_contract", "temporal_validation", "resume_stream", "latest_pointer",
         "resume_batch"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark):
    bad = []
    for name, fn in QUERIES.items():
        if name in _SKIP:
            continue
        plan = _plan(fn(spark, SF0001))
        bad += [(name, w) for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in plan]
    assert bad == []


def test_training_features_plan(spark):
    plan = _plan(E.queries()["station_features"](spark, SF0001))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 1
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(user_id)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


@pytest.mark.parametrize("name", ["nearest_pixel_join", "clip_rings", "sample_points", "trend_window"])
def test_spatial_joins_are_equi_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert "HashJoin" in plan or "SortMergeJoin" in plan
