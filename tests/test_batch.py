"""The batch job's shared tables give the rows of the plain graph, and move the game tables once."""

import math

import pytest
from pyspark.sql import functions as F

from courtload.operators import clean, joins, training
from courtload.plans import batch
from courtload.plans.graph import Graph
from courtload.sources.adapters import Domain, load_domain
from tests.conftest import SF_SMALL


def _near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    a, b = (sorted((tuple(r) for r in d.select(*sorted(want.columns)).collect()),
                   key=lambda r: [f"{x:.6g}" if isinstance(x, float) else repr(x) for x in r]) for d in (got, want))
    assert len(a) == len(b) and all(_near(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


def _odd_domain(spark):
    """Games listed twice on a day and on two days, rows without a game, players of two teams in a game, keys of one side only."""
    d = load_domain(spark, SF_SMALL)
    sched = d.schedule
    again = sched.where("game_id % 5 = 0").withColumn("travel_distance_miles", F.lit(7.0))
    later = sched.where("game_id % 7 = 0").withColumn("date", F.date_add("date", 1))
    none = sched.limit(3).withColumn("game_id", F.lit(None).cast("long"))
    tracking = d.tracking.where("player_id <> 3 AND game_id % 11 <> 0")
    tracking = tracking.unionByName(tracking.where("player_id = 2").withColumn("team_id", F.lit(99))).unionByName(
        tracking.limit(5).withColumn("game_id", F.lit(None).cast("long")))
    return Domain(tracking, d.stats.where("player_id <> 4"), sched.where("game_id % 13 <> 0").unionByName(again).unionByName(later).unionByName(none),
                  d.training, d.incidents)


@pytest.mark.parametrize("by_game", [True, False])
def test_shared_tables_give_the_plain_rows(spark, monkeypatch, tmp_path, by_game):
    d = _odd_domain(spark)
    if by_game:
        monkeypatch.setattr(batch, "FEATURE_ROWS", 10)
        monkeypatch.setattr(batch, "FEW_INCIDENTS", 10)
        monkeypatch.setattr(joins, "spread", lambda *a, **kw: joins.Spread(True, 4951))
    else:
        monkeypatch.setattr(joins, "games_spread", lambda t, s: joins.Spread(False, 0))
    paths = batch.run_batch(spark, domain=d, root=str(tmp_path), fail_on_gate=False)
    g = Graph(d)
    assert g.pgw.groupBy("player_id", "game_id").count().where("count > 2").count() > 0
    for name, want in {"tracking_with_stats": g.keyed, "tracking_stats_schedule": g.keyed_sched, "player_game_workload": g.pgw,
                       "rolling_workload": g.rolling, "training_with_schedule": g.training_sched, "training_load_analysis": g.load,
                       "injury_risk_features": g.features}.items():
        got = spark.read.parquet(paths[name])
        _same(got, want)
        if name != "rolling_workload":      # written by team
            assert got.columns == want.columns
    gates = {r["check"]: r["failures"] for r in spark.read.parquet(str(tmp_path / "analytics/quality_gates.parquet/version=*")).collect()
             if r["check"] == "tracking_completeness"}
    assert gates["tracking_completeness"] == joins.coverage_gaps(d.stats, d.tracking, ["game_id", "player_id"]).count()


def test_game_tables_move_once(spark, monkeypatch, tmp_path):
    plans, publish = {}, batch.publish_version

    def seen(df, path, *a, **kw):
        plans[path.split("/")[-1].split(".")[0]] = df._jdf.queryExecution().executedPlan().toString()
        return publish(df, path, *a, **kw)
    monkeypatch.setattr(batch, "publish_version", seen)
    monkeypatch.setattr(joins, "DEALT_ROWS", 500)
    for name in ("FEATURE_ROWS", "FEW_INCIDENTS"):
        monkeypatch.setattr(batch, name, 10)
    even = joins.Spread(True, 4951)         # ten players, each crowded
    monkeypatch.setattr(joins, "spread", lambda *a, **kw: even)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch.run_batch(spark, SF_SMALL, root=str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # J8 and the training means join the snapshot where it was dealt once
    made = plans["injury_risk_features"].split("Exchange hashpartitioning(")[1:]
    assert sum(m.startswith("player_id") and "REPARTITION_BY_NUM" in m.split("\n")[0] for m in made) == 3
    assert not any(m.startswith("_at") or m.startswith("_key") for m in made)
    assert "Join" not in plans["intensity_performance"] + plans["ratio_performance"]
    assert "Exchange" not in plans["tracking_stats_schedule"]
    # only rows of games listed several times are grouped
    alone, several = plans["player_game_workload"].split("Union")[1].split("HashAggregate", 1)
    assert "Exchange" not in alone and "_listed" in several
    # W1's shuffle is the one that the partitioned write needs
    assert plans["rolling_workload"].count("Exchange rangepartitioning") == 1
    assert "hashpartitioning(player_id" not in plans["rolling_workload"].split("Exchange rangepartitioning")[0]
    # A12 and A15a don't read J4's rows, which are sessions times games
    assert "game_id" not in plans["training_load_analysis"]


def test_a_crowded_game_is_not_dealt_whole(spark, monkeypatch):
    rows = spark.range(4000).select(F.when(F.col("id") < 100, 1).otherwise(F.col("id")).alias("game_id"), F.lit(1).alias("player_id"))
    assert joins.games_spread(rows, rows) == joins.Spread(True, 4000)       # few rows
    monkeypatch.setattr(joins, "GAME_ROWS", 50)
    assert not joins.games_spread(rows, rows).even
    assert joins.spread(rows, ["game_id"], share=0.02, few=200).even and not joins.spread(rows, ["game_id"], share=0.02).even


def test_j4_summed_up_per_session(spark):
    d = _odd_domain(spark)
    g = Graph(d)
    sessions = g.training_team.unionByName(g.training_team.limit(4)).withColumn(
        "intensity_score", F.when(F.col("intensity_score") < 20, F.col("intensity_score")))
    whole, summed = joins.join_schedule(sessions, d.schedule), joins.schedule_weights(sessions, d.schedule)
    assert summed.agg(F.sum("w_rows")).first()[0] == whole.count() > sessions.count() == summed.count()
    from courtload.operators import risk
    _same(training.training_load_analysis(summed, training.J4_WEIGHTS), training.training_load_analysis(whole))
    _same(risk.training_summary(summed, training.J4_WEIGHTS), risk.training_summary(whole))


def test_only_repeated_keys_are_grouped(spark):
    rows = spark.createDataFrame([(1, 1, 5.0), (1, 1, 4.0), (1, 2, 3.0), (None, 1, 2.0), (None, 1, 1.0), (3, None, None)], "a int, b int, v double")
    keys = rows.groupBy("a", "b").count().where("count > 1").select("a", "b")
    got = clean.dedupe_keys(rows, ["a", "b"], keys)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, clean.dedupe_keys(rows, ["a", "b"]).collect()))
    assert clean.dedupe_keys(rows, ["a", "b"], keys.limit(0)).count() == rows.count()
