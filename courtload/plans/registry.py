"""Registered queries: name -> f(spark, sf_dir) -> DataFrame over the driver tables.

Each query builds the lazy graph over the whole tables of ``sf_dir`` and
returns one node, with floating columns rounded to 6 decimals for
presentation (HALF_UP, the same in the SQL oracle).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtload import config
from courtload import schemas as _schemas
from courtload.functions.exprs import round_doubles, sround, utc_wallclock
from courtload.operators import alerts as _alerts
from courtload.operators import clean, impact, joins, quality, risk, team_windows, training, workload
from courtload.plans import batch as _batch
from courtload.plans.graph import Graph
from courtload.plans.increment import Increments
from courtload.session import materialize, scratch_path
from courtload.sources import files as _files
from courtload.sources import telemetry as _tel
from courtload.sources.adapters import INPUTS, Domain, telemetry_events
from courtload.streaming import telemetry as _st

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str, rounded: bool = False):
    """``rounded``: the query's rows come rounded already."""
    def deco(fn: Callable[..., DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir) if rounded else round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _g(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph.of(spark, sf_dir, pairs=joins.PART_PAIRS, deal=True)


def _rolled(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph for what reads W1, its per-game table written once: W1 reads it twice, and J1 and J5 then run once."""
    g = _g(spark, sf_dir)
    g.pin_games(materialize(g.pgw, "player-games"))
    return g


# ---- J1 / A1 / W1: the minimum slice ------------------------------------------------
@query("join_tracking_stats")
def _join_tracking_stats(spark, sf):
    """J1 at key grain: tracking rows, stats rows and joined rows per (game, player, team)."""
    k = _g(spark, sf).keyed
    return k.select("game_id", "player_id", "team_id",
                    F.col("n_track").alias("tracking_rows"), F.col("n_stats").alias("stats_rows"),
                    "pair_rows",
                    (F.col("n_stats") * F.col("s_distance_covered_ft")).alias("joined_distance_ft"),
                    (F.col("n_track") * F.col("s_minutes_played")).alias("joined_minutes"))


@query("player_game_workload")
def _pgw(spark, sf):
    """A1."""
    return _g(spark, sf).pgw


@query("rolling_workload")
def _rolling(spark, sf):
    """W1 (flagship)."""
    return _rolled(spark, sf).rolling



@query("incremental_rolling_workload")
def _rolling_added(spark, sf):
    """W1 by increments (S6): the season up to its last 30 days, then the rest, which rebuilds only the partitions it reaches."""
    d = _g(spark, sf).d
    cut = d.schedule.agg(F.date_sub(F.max("date"), 30)).scalar()
    early = d.schedule.where(F.col("date") <= cut).select("game_id").distinct()
    tables = (d.tracking, d.stats, d.schedule)
    # the games that are not early are few: written, they are broadcast by their size, and the raw rows are parted where they lie
    games = reduce(DataFrame.unionByName, [t.select("game_id").distinct() for t in tables]).distinct()
    late = materialize(games.join(early, "game_id", "left_anti").withColumnRenamed("game_id", "_late"), "late-games")
    kept = Increments(spark, scratch_path(spark, "increments"))
    for name, how in (("season", "left_anti"), ("last-days", "left_semi")):
        kept.add(name, Domain(*(t.join(late, F.col("game_id").eqNullSafe(F.col("_late")), how) for t in tables), d.training, d.incidents))
    return kept.rolling()


# ---- cleaning and profiles (C3-C11) -----------------------------------------------------
@query("clean_heart_rate")
def _clean_hr(spark, sf):
    """Tracking rows with heart rate in [60, 220]."""
    return clean.keep_in_range(_g(spark, sf).d.tracking, "heart_rate_bpm", *config.HR_KEEP)


@query("out_of_range_counts")
def _oor(spark, sf):
    """C4: heart-rate values outside [60, 220] in tracking and training."""
    d = _g(spark, sf).d
    a = clean.out_of_range_counts(d.tracking, {"heart_rate_bpm": config.HR_KEEP})
    b = clean.out_of_range_counts(d.training, {"heart_rate_avg": config.HR_KEEP, "heart_rate_max": config.HR_KEEP})
    return (a.withColumn("table", F.lit("player_tracking"))
             .unionByName(b.withColumn("table", F.lit("training_sessions"))))


@query("clean_dates")
def _clean_dates(spark, sf):
    """Training sessions with the date string parsed (malformed -> NULL)."""
    return _g(spark, sf).training_clean


@query("clean_incidents")
def _clean_incidents(spark, sf):
    """C6 + C5: incidents with defaults filled and the date parsed."""
    return _g(spark, sf).incidents


def _profile_tables(g: Graph) -> dict:
    return {"player_tracking": g.d.tracking, "game_stats": g.d.stats, "injury_reports": g.d.incidents,
            "training_sessions": g.d.training, "team_schedules": g.d.schedule}


@query("null_profile")
def _null_profile(spark, sf):
    """NULL count of every column of the five raw tables, long form."""
    parts = []
    for name, df in _profile_tables(_g(spark, sf)).items():
        wide = clean.null_profile(df)
        rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns]
        parts.append(wide.select(F.explode(F.array(*rows)).alias("r"))
                         .select(F.lit(name).alias("table"), "r.*"))
    return quality._union(parts)


DESCRIBE = {
    "player_tracking": ("heart_rate_bpm", "x_court_ft", "y_court_ft"),
    "training_sessions": ("heart_rate_avg", "heart_rate_max", "intensity_score", "sleep_hours_prev_night"),
    "team_schedules": ("travel_distance_miles", "rest_days_since_last_game"),
}


@query("describe_profile")
def _describe(spark, sf):
    """Count / mean / stddev / min / max of chosen numeric columns."""
    tables = _profile_tables(_g(spark, sf))
    return quality._union([clean.describe_profile(tables[t], cols).withColumn("table", F.lit(t))
                           for t, cols in DESCRIBE.items()])


@query("table_census")
def _census(spark, sf):
    """C11: rows and columns of the five raw tables."""
    return clean.table_census(_profile_tables(_g(spark, sf)))


@query("player_team_map")
def _ptm(spark, sf):
    """D1."""
    return clean.player_team_map(_g(spark, sf).d.tracking)


@query("dedupe_snapshot")
def _snap(spark, sf):
    """One workload row per (player, game)."""
    return risk.workload_snapshot(_rolled(spark, sf).rolling)


# ---- joins (J2-J11) -----------------------------------------------------------------------
@query("join_training_by_date")
def _j2(spark, sf):
    """J2 fan-out diagnostic per date."""
    g = _g(spark, sf)
    return joins.join_training_by_date(g.training_clean, g.d.schedule)


@query("join_training_team")
def _j3(spark, sf):
    """J3."""
    return _g(spark, sf).training_team


@query("join_training_schedule", rounded=True)
def _j4(spark, sf):
    """J4 (training_with_schedule).  Its rows are sessions times games, so both are rounded before the join and not in each row."""
    g = _g(spark, sf)
    g.pin("training_team", round_doubles(g.training_team))
    g.d.schedule = round_doubles(g.d.schedule)
    return g.training_sched


@query("join_schedule_context")
def _j5(spark, sf):
    """J5 at key grain."""
    return _g(spark, sf).keyed_sched.select(
        "game_id", "player_id", "team_id", "pair_rows", "date", "back_to_back",
        "travel_distance_miles", "rest_days_since_last_game")


@query("join_week_performance")
def _j7(spark, sf):
    """J7."""
    return _g(spark, sf).week_perf


@query("horizon_label")
def _j8(spark, sf):
    """Snapshot rows with the 7-day injury label."""
    g = _rolled(spark, sf)
    return joins.horizon_label(risk.workload_snapshot(g.rolling), g.incidents, label=risk.LABEL)


@query("coverage_gaps")
def _j11(spark, sf):
    """Box-score keys without tracking."""
    d = _g(spark, sf).d
    return joins.coverage_gaps(d.stats, d.tracking, ["game_id", "player_id"])


@query("coverage_gaps_clean")
def _j11c(spark, sf):
    """J11 after cleaning (C3): box-score keys none of whose tracking samples has a heart rate in [60, 220]."""
    d = _g(spark, sf).d
    usable = clean.keep_in_range(d.tracking, "heart_rate_bpm", *config.HR_KEEP)
    return joins.coverage_gaps(d.stats, usable, ["game_id", "player_id"])


@query("schedule_gaps")
def _j11s(spark, sf):
    """Scheduled games without tracking."""
    d = _g(spark, sf).d
    return joins.coverage_gaps(d.schedule, d.tracking, ["game_id"])


# ---- workload and impact (A2-A11, A18, A19) -----------------------------------------------
@query("workload_tiers")
def _a2(spark, sf):
    return workload.workload_tiers(materialize(workload.tier_columns(_rolled(spark, sf).rolling), "tier-columns"))


@query("back_to_back_analysis")
def _a3(spark, sf):
    return _g(spark, sf).btb


@query("back_to_back_summary")
def _a4(spark, sf):
    return impact.back_to_back_summary(_g(spark, sf).btb)


@query("back_to_back_readout")
def _a4b(spark, sf):
    return impact.back_to_back_readout(_g(spark, sf).btb)


@query("back_to_back_pivot")
def _a5(spark, sf):
    return impact.back_to_back_pivot(_g(spark, sf).btb)


@query("resilience_split")
def _a6(spark, sf):
    return impact.resilience_split(_g(spark, sf).resilience)


@query("resilience_extremes")
def _a6b(spark, sf):
    return impact.resilience_extremes(_g(spark, sf).resilience)


@query("resilience_stats")
def _a7(spark, sf):
    return impact.resilience_stats(_g(spark, sf).resilience)


@query("season_profile")
def _a8(spark, sf):
    return _g(spark, sf).profile


@query("btb_by_profile")
def _a8b(spark, sf):
    g = _g(spark, sf)
    return impact.btb_by_profile(g.btb, g.profile)


@query("travel_rest_analysis")
def _a9(spark, sf):
    return impact.travel_rest_analysis(_g(spark, sf).keyed_sched)


@query("travel_bucket_analysis")
def _a10(spark, sf):
    return impact.travel_bucket_analysis(_g(spark, sf).keyed_sched)


@query("travel_correlations")
def _a11(spark, sf):
    return impact.travel_correlations(_g(spark, sf).keyed_sched)


@query("player_thresholds")
def _a18(spark, sf):
    return _g(spark, sf).thresholds


@query("top_workload")
def _a19(spark, sf):
    return workload.top_workload(_rolled(spark, sf).rolling)


@query("readout_back_to_back")
def _r1(spark, sf):
    """R1."""
    b = _g(spark, sf).btb
    return b.select("back_to_back", "games_played", sround("avg_plus_minus", 2).alias("avg_plus_minus"),
                    sround("avg_minutes", 1).alias("avg_minutes"),
                    sround("avg_distance_ft", 1).alias("avg_distance_ft"),
                    sround("avg_heart_rate", 1).alias("avg_heart_rate"),
                    sround("shooting_pct", 1).alias("shooting_pct")).orderBy("back_to_back")


@query("readout_travel_rest")
def _r2(spark, sf):
    """R2."""
    t = impact.travel_rest_analysis(_g(spark, sf).keyed_sched)
    return t.select("rest_days_since_last_game", "back_to_back", "total_records",
                    sround("avg_heart_rate", 1).alias("avg_heart_rate"),
                    sround("avg_distance_ft", 1).alias("avg_distance_ft"),
                    sround("avg_plus_minus", 2).alias("avg_plus_minus"),
                    sround("avg_travel_miles", 1).alias("avg_travel_miles"),
                    sround("shooting_pct", 1).alias("shooting_pct")).orderBy("rest_days_since_last_game")


# ---- training (A12-A14b) -----------------------------------------------------------------
@query("training_load_analysis")
def _a12(spark, sf):
    return _g(spark, sf).load


@query("training_load_by_type")
def _a12b(spark, sf):
    return training.training_load_by_type(_g(spark, sf).load)


@query("weekly_training")
def _a13(spark, sf):
    return _g(spark, sf).weekly


@query("intensity_performance")
def _a14(spark, sf):
    return training.intensity_performance(_g(spark, sf).week_perf)


@query("ratio_performance")
def _a14b(spark, sf):
    return training.ratio_performance(_g(spark, sf).week_perf)


# ---- risk (A15-A17, A22) -----------------------------------------------------------------
@query("injury_risk_features")
def _a15(spark, sf):
    return _rolled(spark, sf).features


@query("training_summary")
def _a15a(spark, sf):
    return risk.training_summary(_g(spark, sf).training_sched)


@query("incident_dates")
def _a15b(spark, sf):
    return risk.incident_dates(_g(spark, sf).incidents)


@query("risk_feature_correlations")
def _a16(spark, sf):
    return risk.label_correlations(_rolled(spark, sf).features)


@query("risk_label_balance")
def _a17(spark, sf):
    return risk.label_balance(_rolled(spark, sf).features)


@query("incident_frequency_by_tier")
def _a22(spark, sf):
    g = _g(spark, sf)
    return risk.incident_frequency_by_tier(g.profile, g.incidents)


# ---- gates (G1-G3) -----------------------------------------------------------------------
@query("gate_inputs")
def _g1(spark, sf):
    return quality.gate_inputs(_profile_tables(_g(spark, sf)))


@query("gate_input_tables")
def _g1t(spark, sf):
    """G1 on files: every expected table is there and has rows; a table that nobody delivers is reported."""
    names = (*INPUTS, "wearables")
    return quality.expect_datasets(_files.input_manifest(spark, sf, names), names, "inputs_present")


@query("gate_impossible_values")
def _g2(spark, sf):
    return quality.gate_impossible_values(_g(spark, sf).d.tracking)


@query("gate_completeness")
def _g3(spark, sf):
    d = _g(spark, sf).d
    return quality.gate_completeness(d.stats, d.tracking)


@query("gate_schedule_completeness")
def _g3s(spark, sf):
    """Every scheduled game has tracking rows."""
    d = _g(spark, sf).d
    return quality.gate_completeness(d.schedule, d.tracking, keys=("game_id",), subject="team_schedules")


# ---- telemetry in batch form (S11, T1, T3, T4, L1-L4, A20, R5, G6) -----------------------


def _decoded(g: Graph) -> DataFrame:
    return _tel.telemetry_decode(_tel.telemetry_encode(telemetry_events(g.d.events)))


def _batch_alerts(g: Graph) -> DataFrame:
    return _alerts.apply_alerts(_alerts.windowed_exertion(_decoded(g), delay=None), g.thresholds)


@query("telemetry_encode")
def _s11(spark, sf):
    """Tracking rows as (key, JSON) messages, fields parsed back."""
    enc = _tel.telemetry_encode(_tel.tracking_messages(_g(spark, sf).d.tracking))
    return enc.select("key", F.from_json("value", _schemas.TELEMETRY).alias("m")).select("key", "m.*")


@query("telemetry_written")
def _s11w(spark, sf):
    """S11 as a job: messages written by player and time, read back, fields parsed."""
    path = scratch_path(spark, "telemetry-messages")
    _tel.write_messages(_tel.tracking_messages(_g(spark, sf).d.tracking), path)
    back = spark.read.parquet(path)
    return back.select("key", F.from_json("value", _schemas.TELEMETRY).alias("m")).select("key", "m.*")


@query("telemetry_source")
def _s4(spark, sf):
    """The feed read as a stream through the live source, landed and read back."""
    path = scratch_path(spark, "landed-events")
    stream = _st.table_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    _st.drain(stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint")
              .trigger(availableNow=True).start(path))
    return spark.read.parquet(path)


@query("telemetry_decode")
def _t1(spark, sf):
    """Decoded telemetry, heart rate kept in [60, 220], event time in whole seconds."""
    dec = _decoded(_g(spark, sf))
    return dec.withColumn("event_timestamp", utc_wallclock("event_timestamp"))


@query("windowed_exertion")
def _t3(spark, sf):
    """T3 over the whole feed as a batch."""
    return _alerts.windowed_exertion(_decoded(_g(spark, sf)), delay=None)


WIDE = {"size": "7 days", "keys": ("player_id",)}    # windows that hold several samples of a player


@query("windowed_exertion_wide")
def _t3w(spark, sf):
    """T3 with a week's windows per player."""
    return _alerts.windowed_exertion(_decoded(_g(spark, sf)), delay=None, **WIDE)


@query("alerts_wide")
def _t4w(spark, sf):
    """T4 on a week's windows."""
    g = _g(spark, sf)
    return _alerts.apply_alerts(_alerts.windowed_exertion(_decoded(g), delay=None, **WIDE), g.thresholds)


@query("stream_alerts")
def _t4(spark, sf):
    """Windows with personal thresholds and alert flags (batch form)."""
    return _batch_alerts(_g(spark, sf))


@query("live_exertion_ranking")
def _l1(spark, sf):
    return _alerts.live_exertion_ranking(_batch_alerts(_g(spark, sf)))


@query("heart_rate_alerts")
def _l2(spark, sf):
    return _alerts.heart_rate_alerts(_batch_alerts(_g(spark, sf)))


@query("distance_alerts")
def _l3(spark, sf):
    return _alerts.distance_alerts(_batch_alerts(_g(spark, sf)))


@query("substitution_candidates")
def _l4(spark, sf):
    return _alerts.substitution_candidates(_batch_alerts(_g(spark, sf)))


@query("team_alert_summary")
def _a20(spark, sf):
    return _alerts.team_alert_summary(_batch_alerts(_g(spark, sf)))


@query("team_summary_rollup")
def _a20r(spark, sf):
    """A20 rolled up from the mergeable summaries of windows, by day and then by team."""
    counts = team_windows.window_counts(_batch_alerts(_g(spark, sf)))
    days = team_windows.merge_counts(counts.withColumn("day", F.to_date("window_start")), ["team_id", "day"])
    return team_windows.team_summary(days)


@query("top_alerts")
def _r5(spark, sf):
    return _alerts.top_alerts(_batch_alerts(_g(spark, sf)))


@query("stream_freshness")
def _g6(spark, sf):
    return _alerts.stream_freshness(_batch_alerts(_g(spark, sf)))


# ---- Structured Streaming (T5-T8, S7, S8) --------------------------------------------------


def _run_live(spark, sf, with_alerts: bool, mode: str = "complete") -> tuple[DataFrame, object]:
    g = _g(spark, sf)
    tel = _st.telemetry_stream(spark, sf)
    df = _st.alert_stream(tel, _st.static_thresholds(g.thresholds)) if with_alerts else _alerts.windowed_exertion(tel)
    name = "player_exertion" if with_alerts else "windowed_exertion_live"
    path, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-checkpoint")
    q = _st.drain(_st.start_live(df, name, ckpt, path, mode=mode))
    return _st.live_table(spark, name, path), q


@query("stream_windowed_exertion_wide")
def _t5w(spark, sf):
    """T3 on the stream with a week's windows per player."""
    df = _alerts.windowed_exertion(_st.telemetry_stream(spark, sf), **WIDE)
    keys, path = ("window_start", "window_end", "player_id"), scratch_path(spark, "windowed_exertion_wide")
    _st.drain(_st.start_live(df, "windowed_exertion_wide", f"{path}-checkpoint", path, keys=keys))
    return _st.live_table(spark, "windowed_exertion_wide", path, keys)


@query("stream_windowed_exertion")
def _t5a(spark, sf):
    """T3 on the stream (complete mode, all windows)."""
    return _run_live(spark, sf, with_alerts=False)[0]


@query("stream_live_exertion")
def _t5(spark, sf):
    """The live alert table after the stream has drained."""
    return _run_live(spark, sf, with_alerts=True)[0]


@query("stream_live_exertion_update")
def _t5u(spark, sf):
    """T5 in update mode (bounded state, latest version per window); equal to T5 when no row is late."""
    return _run_live(spark, sf, with_alerts=True, mode="update")[0]


@query("stream_team_summary")
def _a20u(spark, sf):
    """A20 of a live feed in update mode: from the summaries that each micro-batch makes anew of the windows it changed."""
    g = _g(spark, sf)
    alerts = _st.alert_stream(_st.telemetry_stream(spark, sf), _st.static_thresholds(g.thresholds))
    path = scratch_path(spark, "team-summary")
    _st.drain(_st.start_live(alerts, "team_summary_live", f"{path}-checkpoint", path, mode="update", summaries=f"{path}-windows"))
    return team_windows.team_summary(_st.team_windows(spark, f"{path}-windows"))


def _run_alert_log(spark, sf):
    g = _g(spark, sf)
    alerts = _st.alert_stream(_st.telemetry_stream(spark, sf), _st.static_thresholds(g.thresholds))
    path, ckpt = scratch_path(spark, "streaming_alerts"), scratch_path(spark, "streaming_alerts-checkpoint")
    q = _st.drain(_st.start_alert_log(alerts, path, ckpt))
    return _st.alert_log(spark, path, alerts.schema), q


@query("stream_alert_sink")
def _t6(spark, sf):
    """Append-mode alert log; windows closed by the watermark."""
    return _run_alert_log(spark, sf)[0]


@query("stream_progress")
def _t8(spark, sf):
    """Progress rows of the alert-log query (rows only)."""
    _, q = _run_alert_log(spark, sf)
    return _st.progress_frame(spark, q).select("batch_id", "num_input_rows", "watermark")


@query("stream_output_freshness")
def _g6s(spark, sf):
    """G6 on what the stream wrote (the live table)."""
    return _alerts.stream_freshness(_run_live(spark, sf, with_alerts=True, mode="update")[0])


@query("gate_alert_output")
def _g5(spark, sf):
    """G5 on the alert log written by the stream."""
    return quality.gate_alert_output(_run_alert_log(spark, sf)[0])


# ---- sources and sinks (S1, S2, S5, S6, S9, S12, R4, G4) -----------------------------------


@query("scan_csv")
def _s1(spark, sf):
    """Tracking written as gzip CSV and read back with its declared schema."""
    path = scratch_path(spark, "player-tracking.csv")
    _g(spark, sf).d.tracking.write.option("header", "true").option("compression", "gzip").csv(path)
    return _files.read_csv(spark, path, _schemas.PLAYER_TRACKING)


@query("scan_json")
def _s2(spark, sf):
    """Box scores written as gzip JSON lines and read back with their declared schema."""
    path = scratch_path(spark, "game-stats.json")
    _g(spark, sf).d.stats.write.option("compression", "gzip").json(path)
    return _files.read_json(spark, path, _schemas.GAME_STATS)


@query("publish_roundtrip")
def _s5(spark, sf):
    """Back-to-back analysis published twice, the second version read back through the pointer."""
    path = scratch_path(spark, "back_to_back_analysis.parquet")
    btb = _g(spark, sf).btb
    _files.publish_version(btb, path)
    _files.publish_version(btb, path)
    return _files.read_published(spark, path)


@query("publish_partitioned")
def _s6(spark, sf):
    """Rolling workload published partitioned by team; per-team census of the read-back."""
    path = scratch_path(spark, "rolling_workload.parquet")
    _files.publish_version(_rolled(spark, sf).rolling, path, partition_by=["team_id"], cluster_by=["player_id", "date", "game_id"])
    back = _files.read_published(spark, path)
    return back.groupBy("team_id").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("rolling_5g_distance").alias("rolling_distance"))


@query("read_optional")
def _s9(spark, sf):
    """A present dataset reads normally; a missing one yields an empty typed frame."""
    present = _files.read_optional(spark, f"{sf}/events.parquet",
                                   spark.read.parquet(f"{sf}/events.parquet").schema)
    missing = _files.read_optional(spark, scratch_path(spark, "absent.parquet"), present.schema)
    return present.unionByName(missing).agg(F.count(F.lit(1)).alias("rows"))


@query("published_census")
def _r4(spark, sf):
    """Row counts of the published datasets, read from the files the batch job wrote."""
    paths = _batch.run_batch(spark, sf)
    return _batch.manifest(spark, paths).select("zone", "dataset", "rows")


@query("dataset_manifest")
def _s12(spark, sf):
    """S12 without the paths, which differ by run."""
    return _batch.manifest(spark, _batch.run_batch(spark, sf)).drop("path")


@query("gate_outputs")
def _g4(spark, sf):
    """G4."""
    return _batch.gate_outputs(spark, _batch.run_batch(spark, sf))
