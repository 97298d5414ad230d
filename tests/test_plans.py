"""Plan shape: pruned scans, no cartesian / nested-loop joins, no one-task windows on data."""

import re

import pytest

from courtload.plans.registry import QUERIES
from tests.conftest import SF_SMALL

SIDE_EFFECT = {"scan_csv", "scan_json", "publish_roundtrip", "publish_partitioned", "published_census",
               "dataset_manifest", "gate_outputs", "stream_windowed_exertion", "stream_live_exertion",
               "stream_live_exertion_update", "stream_windowed_exertion_wide", "stream_output_freshness", "telemetry_source",
               "telemetry_written", "stream_team_summary", "incremental_rolling_workload",
               "stream_alert_sink", "stream_progress", "gate_alert_output", "read_optional"}
BATCH = sorted(set(QUERIES) - SIDE_EFFECT)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lineitem_scan_is_pruned(spark):
    plan = _plan(QUERIES["player_game_workload"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_returnflag" not in s and "l_linestatus" not in s for s in li)


def test_rolling_window_is_chunked(spark):
    plan = _plan(QUERIES["rolling_workload"](spark, SF_SMALL))
    windows = re.findall(r"Window \[(.*?)\], \[([^\]]*)\], \[", plan)
    # frames over rows run per chunk; the other windows run over the splitter table's counts
    assert sum("_chunk" in by for _, by in windows) == 1
    assert all("_chunk" in by or not any(c in made for c in ("distance", "avg_hr", "minutes")) for made, by in windows)


def test_building_the_rolling_frame_starts_no_job(spark):
    from courtload.plans.graph import Graph
    pgw = Graph.of(spark, SF_SMALL).pgw
    pgw.schema
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    try:
        from courtload.operators import workload
        workload.rolling_workload(pgw).schema
        assert not sc.statusTracker().getJobIdsForGroup("building")
    finally:
        sc.setJobGroup("", "")


def test_tiers_are_one_case_over_the_rows(spark):
    plan = _plan(QUERIES["workload_tiers"](spark, SF_SMALL))
    assert "Window [" not in plan and "rangepartitioning" not in plan and "Sort [" not in plan
    assert plan.count("CASE WHEN") == 1, plan


def test_only_bounded_single_partition_exchanges(spark):
    # the only SinglePartition exchange feeds the per-partition offset table
    plan = _plan(QUERIES["workload_tiers"](spark, SF_SMALL))
    for block in plan.split("Exchange SinglePartition")[1:]:
        assert "_pid" in block.split("\n")[1] or "count(1)" in block.split("\n")[1] or "_cnt" in block


def test_without_broadcasts_joins_are_sort_merge_and_results_agree(spark):
    # at cluster scale the size checks refuse to broadcast the joined sides; the
    # sort-merge plan must then carry the J1 / J5 joins and give the same rows
    from courtload.functions.exprs import round_doubles
    q = QUERIES["player_game_workload"]
    before = sorted(tuple(r) for r in round_doubles(q(spark, SF_SMALL), 6).collect())
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = q(spark, SF_SMALL)
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(tuple(r) for r in round_doubles(df, 6).collect()) == before
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("name", ["rolling_workload", "dedupe_snapshot", "horizon_label", "top_workload"])
def test_rolling_reads_a_written_per_game_table(spark, name):
    # W1 reads its input twice; from raw rows J1 and J5 would run twice
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "total_distance_ft" in plan and "l_orderkey" not in plan


@pytest.mark.parametrize("name", ["horizon_label", "workload_tiers", "top_workload", "risk_feature_correlations",
                                  "substitution_candidates", "gate_alert_output"])
def test_raw_rows_are_dealt_for_j1(spark, monkeypatch, name):
    # partial sums of raw rows would hold all keys of a scan task
    from courtload.operators import joins
    asked, plain = [], joins.side_summaries
    monkeypatch.setattr(joins, "side_summaries", lambda *a, **kw: asked.append(kw.get("deal")) or plain(*a, **kw))
    QUERIES[name](spark, SF_SMALL)
    assert asked == [True]
