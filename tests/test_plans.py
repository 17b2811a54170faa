"""The physical plans: no cross joins, pruned scans, limits before shuffles."""

import os

import pytest

from tickweave.plans.catalog import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


def plan(spark, name):
    return all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "symbol_pairs", "overlap_join", "hy_correlation_sliding", "discretize", "filter_focus_players",
    "subscribe_pairs", "snapshot_at", "replay_selection", "edge_changes",
])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "symbol_pairs")
    assert "ReadSchema: struct<user_id:bigint>" in text and "props" not in text


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,error)" in plan(spark, "with_parameter_merged")


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "top_hubs_windowed")
    assert "TakeOrderedAndProject" in plan(spark, "top_hubs")


def test_oracles_belong_to_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
