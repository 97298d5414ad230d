"""Windowed exertion, personal-threshold alerts and their readouts.

The same functions run on a batch DataFrame and on a streaming one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtload import config
from courtload.functions.exprs import sround, utc_wallclock

KEYS = ("player_id", "team_id", "game_id")


def windowed_exertion(telemetry: DataFrame, size: str = config.WINDOW, delay: str | None = config.WATERMARK,
                      keys: Sequence[str] = KEYS, time_col: str = "event_timestamp") -> DataFrame:
    """Tumbling windows per (player, team, game).

    Window bounds are returned as UTC wall-clock TIMESTAMP_NTZ so the output
    does not depend on the session time zone.
    """
    src = telemetry.withWatermark(time_col, delay) if delay else telemetry
    agg = src.groupBy(F.window(F.col(time_col), size), *keys).agg(
        sround(F.avg("heart_rate_bpm"), 1).alias("avg_heart_rate"),
        sround(F.max("heart_rate_bpm"), 1).alias("max_heart_rate"),
        sround(F.sum("cumulative_distance"), 1).alias("total_distance_ft"),
        sround(F.avg("speed_mph"), 2).alias("avg_speed_mph"),
        F.count(F.lit(1)).alias("tracking_frames"),
    )
    return agg.select(
        utc_wallclock(F.col("window.start")).alias("window_start"),
        utc_wallclock(F.col("window.end")).alias("window_end"),
        *keys, "avg_heart_rate", "max_heart_rate", "total_distance_ft", "avg_speed_mph", "tracking_frames",
    )


def apply_alerts(exertion: DataFrame, thresholds: DataFrame, hr_default: float = config.HR_FALLBACK,
                 distance_default: float = config.DISTANCE_FALLBACK, distance_scale: float = 1.0) -> DataFrame:
    """Left join personal thresholds (defaults when missing) and flag the windows.

    The distance threshold comes from per-game totals while the window sum
    covers one window; ``distance_scale`` (e.g. window length / game length)
    rescales it.  1.0 is the reference behaviour.
    """
    thr = thresholds.select(F.col("player_id").cast("string").alias("player_id"), "hr_alert_threshold",
                            (F.col("distance_alert_threshold") * distance_scale).alias("distance_alert_threshold")
                            if distance_scale != 1.0 else F.col("distance_alert_threshold"))
    j = exertion.join(thr, "player_id", "left").fillna(
        {"hr_alert_threshold": hr_default, "distance_alert_threshold": distance_default})
    return (j.withColumn("heart_rate_alert", F.col("avg_heart_rate") >= F.col("hr_alert_threshold"))
             .withColumn("distance_alert", F.col("total_distance_ft") >= F.col("distance_alert_threshold"))
             .withColumn("fatigue_alert", F.col("heart_rate_alert") | F.col("distance_alert")))


def _miles(col: str) -> F.Column:
    return sround(F.col(col) / config.FEET_PER_MILE, 2)


def live_exertion_ranking(alerts: DataFrame) -> DataFrame:
    """L1: every window, flagged first, then by heart rate."""
    return alerts.select(
        "player_id", "team_id", "game_id", "window_start", "window_end", "avg_heart_rate",
        "max_heart_rate", "hr_alert_threshold", _miles("total_distance_ft").alias("distance_miles"),
        _miles("distance_alert_threshold").alias("threshold_miles"), "tracking_frames",
        "heart_rate_alert", "distance_alert", "fatigue_alert",
    ).orderBy(F.col("fatigue_alert").desc(), F.col("avg_heart_rate").desc())


def heart_rate_alerts(alerts: DataFrame) -> DataFrame:
    """L2."""
    return (alerts.filter(F.col("heart_rate_alert"))
                  .select("player_id", "team_id", "game_id", "avg_heart_rate", "hr_alert_threshold",
                          "heart_rate_alert")
                  .orderBy(F.col("avg_heart_rate").desc()))


def distance_alerts(alerts: DataFrame) -> DataFrame:
    """L3."""
    return (alerts.filter(F.col("distance_alert"))
                  .select("player_id", "team_id", "game_id", _miles("total_distance_ft").alias("distance_miles"),
                          _miles("distance_alert_threshold").alias("threshold_miles"), "distance_alert",
                          "total_distance_ft")
                  .orderBy(F.col("total_distance_ft").desc())
                  .drop("total_distance_ft"))


def substitution_candidates(alerts: DataFrame) -> DataFrame:
    """L4."""
    return (alerts.filter(F.col("fatigue_alert"))
                  .select("player_id", "team_id", "game_id", "avg_heart_rate", "hr_alert_threshold",
                          _miles("total_distance_ft").alias("distance_miles"),
                          _miles("distance_alert_threshold").alias("threshold_miles"),
                          "heart_rate_alert", "distance_alert")
                  .orderBy(F.col("avg_heart_rate").desc()))


def team_alert_summary(alerts: DataFrame) -> DataFrame:
    """A20."""
    def flag(c: str):
        return F.sum(F.when(F.col(c) == F.lit(True), 1).otherwise(0))
    return alerts.groupBy("team_id").agg(
        F.count_distinct("player_id").alias("players_monitored"),
        flag("fatigue_alert").alias("total_alerts"),
        flag("heart_rate_alert").alias("hr_alerts"),
        flag("distance_alert").alias("distance_alerts"),
        sround(F.avg("avg_heart_rate"), 1).alias("team_avg_hr"),
    )


def top_alerts(alerts: DataFrame, k: int = 5) -> DataFrame:
    """Most severe fatigue alerts by heart rate (ties by player, window, game)."""
    return (alerts.filter(F.col("fatigue_alert"))
                  .orderBy(F.col("avg_heart_rate").desc(), F.col("player_id"), F.col("window_start"),
                           F.col("game_id"), F.col("team_id"))
                  .limit(k))


def stream_freshness(alerts: DataFrame, by: str = "team_id") -> DataFrame:
    """Per team, the newest closed window, window and alert counts, and how many windows are missing
    between the team's first and last one (windows in which no player of the team was heard of)."""
    length = F.max(F.timestamp_diff("SECOND", F.col("window_start"), F.col("window_end")))
    span = F.timestamp_diff("SECOND", F.min("window_start"), F.max("window_end"))
    return alerts.groupBy(by).agg(
        F.max("window_end").alias("latest_window_end"),
        F.min("window_start").alias("first_window_start"),
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("fatigue_alert")).alias("alert_windows"),
        (span / length - F.count_distinct("window_start")).cast("long").alias("windows_missing"),
    )
