"""Join rewrites keep the rows of the plain formulation."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from courtload.operators import joins
from courtload.operators.joins import attach_team


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _with(spark, conf, run):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16"}


def _hot_sessions(spark):
    """A third of all rows, some of them equal, belong to player 0."""
    return spark.range(60000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("player_id"),
                                     (F.col("id") % 500).alias("v"))


def test_the_small_side_is_broadcast_by_its_true_size(spark):
    sessions = _hot_sessions(spark)
    tracking = spark.range(50).select(F.col("id").alias("player_id"), (F.col("id") % 7).alias("team_id"))
    size = int(tracking.select("player_id", "team_id")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    key = "spark.sql.autoBroadcastJoinThreshold"
    over = _with(spark, {key: str(size - 1), "spark.sql.adaptive.enabled": "false"},
                 lambda: _final_plan(attach_team(sessions, tracking)))
    under = _with(spark, {key: str(4 * size)}, lambda: _final_plan(attach_team(sessions, tracking)))
    assert "BroadcastHashJoin" in under and "BroadcastHashJoin" not in over
    assert "Generate explode" not in under + over        # nothing is copied per salt


def test_a_hot_player_is_split(spark):
    from courtload.session import materialize
    sessions = _hot_sessions(spark)
    bridge = materialize(spark.range(50).select(F.col("id").alias("player_id"), (F.col("id") % 7).alias("team_id")), "bridge")
    plan = _with(spark, SKEW, lambda: _final_plan(sessions.join(bridge, "player_id", "left")))
    assert "isSkewJoin=true" in plan or "skew=true" in plan
    assert attach_team(sessions, bridge).count() == 60000


def test_hot_date_team_key_in_j4_is_split_by_aqe(spark):
    # J4 keeps the sessions side whole and leaves a hot (date, team) key to AQE's skew-join
    # split; on a cluster the thresholds are hundreds of MB, scaled down here to the test size
    import datetime as dt

    from courtload.operators.joins import join_schedule
    day = dt.date(1996, 1, 1)
    sessions = spark.range(60000).select(
        F.col("id").alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.lit(day)).otherwise(F.date_add(F.lit(day), (F.col("id") % 200).cast("int")))
         .alias("date"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 25).cast("int").alias("team_id"))
    games = spark.range(400).select(
        F.col("id").alias("game_id"), F.date_add(F.lit(day), (F.col("id") % 200).cast("int")).alias("date"),
        (F.col("id") % 25).cast("int").alias("home_team"), ((F.col("id") + 7) % 25).cast("int").alias("away_team"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = join_schedule(sessions, games)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = len(out.collect())                      # runs this plan, so AQE finalises it
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" in final or "skew=true" in final
    cond = (sessions["date"] == games["date"]) & \
        ((sessions["team_id"] == games["home_team"]) | (sessions["team_id"] == games["away_team"]))
    assert rows == sessions.join(games, cond, "left").count()


def test_hot_keys_are_found_and_split_without_adaptive_skew_joins(spark):
    from courtload.operators.joins import hot_keys, join_schedule
    day = F.expr("date_add(DATE'2000-01-01', cast(id % 200 as int))")
    hot = F.col("id") % 3 == 0
    sessions = spark.range(30_000).select(F.col("id").alias("session"), F.when(F.col("id") % 50 != 7, F.when(hot, F.lit("2000-03-01").cast("date")).otherwise(day)).alias("date"),
                                          F.when(hot, 5).otherwise(F.col("id") % 30).cast("int").alias("team_id"))
    schedule = spark.range(6000).select(F.col("id").alias("game_id"), F.expr("date_add(DATE'2000-01-01', cast(id div 30 as int))").alias("date"),
                                        (F.col("id") % 30).cast("int").alias("home_team"), ((F.col("id") + 11) % 30).cast("int").alias("away_team"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        keys = hot_keys(sessions, ["date", "team_id"])
        assert len(keys.hashes) == 1 and keys.parts >= 5
        plain, split = join_schedule(sessions, schedule), join_schedule(sessions, schedule, split=keys)
        cols = sorted(plain.columns)
        assert sorted(split.columns) == cols
        assert sorted(map(tuple, split.select(cols).collect()), key=repr) == sorted(map(tuple, plain.select(cols).collect()), key=repr)

        def most(df):
            sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            return sizes[-1], sizes[len(sizes) // 2]
        top, median = most(split)
        assert top <= 3 * median < most(plain)[0]
        assert not hot_keys(sessions.where("team_id <> 5"), ["date", "team_id"]).hashes
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_games_split_in_the_schedule_context(spark):
    from courtload.operators.joins import HotKeys, hot_keys, schedule_context
    keyed = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("game_id"), F.col("id").alias("player_id"))
    sched = spark.range(0, 2000, 2).select(F.col("id").alias("game_id"), F.lit(None).cast("date").alias("date"), (F.col("id") % 2).alias("back_to_back"),
                                           F.col("id").cast("double").alias("travel_distance_miles"), F.lit(1).alias("rest_days_since_last_game"))
    keys = hot_keys(keyed, ["game_id"])
    assert isinstance(keys, HotKeys) and len(keys.hashes) == 1
    plain, split = schedule_context(keyed, sched), schedule_context(keyed, sched, split=keys)
    assert split.columns == plain.columns
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def _sessions_and_games(spark, sessions=240, games=30):
    left = [(i, "d1" if i % 3 else ("d2" if i % 2 else None), 1 if i % 5 else None) for i in range(sessions)] + [(7, "d1", 1)] * 3
    right = [(g, "d1" if g % 4 else "d2", 1, 1 if g % 2 else 2) for g in range(games)] + [(99, "d9", 1, 2), (98, None, 1, None)]
    return (spark.createDataFrame(left, "player_id long, date string, team_id int"),
            spark.createDataFrame(right, "game_id long, date string, home_team int, away_team int"))


def test_schedule_join_split_by_joined_rows(spark):
    sessions, games = _sessions_and_games(spark)
    plain = sorted(map(repr, joins.join_schedule(sessions, games).collect()))
    on = [("date", "_d"), ("team_id", "_t")]
    exploded = games.select("game_id", F.col("date").alias("_d"), F.col("home_team").alias("_t"))
    parts = joins.pair_parts(sessions, exploded, on, 100)
    biggest = max(r["_parts"] for r in parts.table.collect())
    assert biggest > 10 and parts.partitions >= biggest
    split = joins.join_schedule(sessions, games, pairs=100)
    assert split.columns == joins.join_schedule(sessions, games).columns
    assert sorted(map(repr, split.collect())) == plain
    made = [r["count"] for r in split.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(made) < len(plain) / 6          # one (date, team) holds nearly all joined rows
    assert joins.pair_parts(sessions, exploded, on, 10**9) is None


def test_joins_before_a_grouping_use_all_partitions(spark):
    sched = spark.createDataFrame([(g, "2024-01-01", True, 1.0, 1) for g in range(50)],
                                  "game_id long, date string, back_to_back boolean, travel_distance_miles double, rest_days_since_last_game int")
    keyed = spark.createDataFrame([(g % 60, g) for g in range(300)], "game_id long, player_id long")
    plain, out = joins.schedule_context(keyed, sched), joins.schedule_context(keyed, sched, deal=True)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, plain.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan       # adaptive execution keeps the given number of partitions


def _raw_sides(spark, hot=0):
    rows = spark.range(4000).select(
        F.when(F.col("id") < hot, 1).when(F.col("id") % 7 != 0, F.floor(F.col("id") / 3)).alias("game_id"),
        F.when(F.col("id") < hot, 1).otherwise(F.col("id") % 5).alias("player_id"), (F.col("id") % 2).alias("team_id"), "id")
    v = F.col("id").cast("double")
    return (rows.select("game_id", "player_id", "team_id", *[v.alias(m) for m in joins.TRACK_MEASURES]),
            rows.select("game_id", "player_id", *[v.alias(m) for m in joins.STATS_MEASURES]))


def test_raw_rows_are_summed_up_where_they_were_dealt(spark):
    tracking, stats = _raw_sides(spark)
    for got, plain in zip(joins.side_summaries(tracking, stats, deal=True), joins.side_summaries(tracking, stats)):
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
        text = got._jdf.queryExecution().sparkPlan().toString()
        assert "REPARTITION_BY_NUM" in text
        exchange = _final_plan(got).split("Initial Plan")[0]
        assert exchange.count("Exchange hashpartitioning") == 1 and "partial_" not in exchange.split("Exchange hashpartitioning")[1]


def test_rows_of_a_crowded_key_are_not_dealt(spark):
    plain, crowded = _raw_sides(spark), _raw_sides(spark, hot=1300)
    known = [df.where("game_id IS NOT NULL") for df in plain]
    assert joins.sides_spread_out(*known) and not joins.sides_spread_out(*crowded)
    assert not joins.spread_out(plain[0], ["game_id"])       # a seventh of the rows has no game
    assert joins.sides_spread_out(*[df.limit(0) for df in plain])


def test_partitions_follow_the_rows(spark, monkeypatch):
    # with the shuffle partitions alone a task's rows, and its memory, grow with the table
    from courtload.plans.registry import QUERIES
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(joins, "DEALT_ROWS", 500)
    tracking, stats = _raw_sides(spark)
    assert joins.sides_spread(tracking.where("game_id IS NOT NULL"), stats.where("game_id IS NOT NULL").limit(100)).rows == 3428
    for side in joins.side_summaries(tracking, stats, deal=True, rows=4000):
        assert "hashpartitioning(game_id, player_id, 8)" in _unnumbered(side)
    for name in ("top_workload", "horizon_label"):
        # 4951 per-game rows
        assert "hashpartitioning(player_id, _chunk, 10)" in _unnumbered(QUERIES[name](spark, SF_SMALL))


def _unnumbered(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_sides_written_once_give_j1_and_its_gate(spark):
    from courtload.operators import quality
    tracking, stats = _raw_sides(spark)
    tracking = tracking.where("player_id <> 3").unionByName(tracking.where("player_id = 2").withColumn("team_id", F.lit(9)))
    stats = stats.where("player_id <> 4")
    t, s = joins.side_summaries(tracking, stats)
    for deal in (False, True):
        sides = joins.outer_summaries(t, s, deal=deal).localCheckpoint()
        for grain in joins.GRAINS:
            want, got = joins.join_summaries(t, s, grain=grain), joins.matched_summaries(sides, grain)
            assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert quality.gate_completeness_from(sides).collect() == quality.gate_completeness(s, t).collect()
        assert quality.gate_completeness_from(sides).first()["failures"] > 0


def test_batch_deals_the_sides_of_j1_once(spark, monkeypatch, tmp_path):
    from courtload.plans import batch
    from tests.conftest import SF_SMALL
    plans, publish = {}, batch.publish_version

    def seen(df, path, *a, **kw):
        plans[path.split("/")[-1]] = df._jdf.queryExecution().executedPlan().toString()
        return publish(df, path, *a, **kw)
    monkeypatch.setattr(batch, "publish_version", seen)
    paths = batch.run_batch(spark, SF_SMALL, root=str(tmp_path))
    assert "Exchange" not in plans["tracking_with_stats.parquet"] and "Join" not in plans["tracking_with_stats.parquet"]
    # J4's repeated games: a codec with a long match window
    assert all(".zstd." in f.name for n in ("training_with_schedule", "rolling_workload") for f in Path(paths[n]).rglob("part-*"))


def test_j4_rounds_its_inputs_and_not_its_rows(spark):
    # its rows are sessions times games
    from courtload.functions.exprs import round_doubles
    from courtload.plans.graph import Graph
    from courtload.plans.registry import QUERIES
    from tests.conftest import SF_MID
    got, want = QUERIES["join_training_schedule"](spark, SF_MID), round_doubles(Graph.of(spark, SF_MID).training_sched)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    above, below = _unnumbered(got).split("Join", 1)
    assert "round(" not in above and "round(" in below
