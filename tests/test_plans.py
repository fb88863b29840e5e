"""Plans: how often a query shuffles, and what reaches the scan."""

import re

import pytest

from kinetrace.plans.queries import QUERIES
from tests.compare import DATA

SF = f"{DATA}/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "most"),
    [("features_paired", 1), ("features_single", 1), ("zone_features", 1), ("nest_approach", 1), ("rolling_median", 1), ("percentile_rank", 1), ("fill_limited", 1), ("parity_swap", 1), ("movement_summary", 1), ("nearest_frame", 2)],
)
def test_operators_of_one_track_share_a_shuffle(spark, name, most):
    assert len(re.findall(r"\bExchange ", plan(spark, name))) <= most


def test_no_cartesian_products(spark):
    for name in ("event_window_mean", "nth_after_event", "shared_windows", "nearest_frame", "identity_correction"):
        assert "CartesianProduct" not in plan(spark, name) and "BroadcastNestedLoopJoin" not in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "line_rollup")
    assert "GreaterThanOrEqual(l_shipdate" in p and "l_comment" not in p and "l_orderkey" not in p
    assert "embedding" not in plan(spark, "movement_summary")


def test_no_python_in_the_library_queries(spark):
    for name in ("features_paired", "clean_paired", "event_metrics", "frechet_distance", "zone_features", "identity_correction"):
        assert not re.search(r"Python|Pandas|Arrow", plan(spark, name))
