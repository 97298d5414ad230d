"""Declared schemas of the domain tables (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


PLAYER_TRACKING = _s(
    ("game_id", LongType()), ("player_id", LongType()), ("team_id", IntegerType()),
    ("timestamp", TimestampNTZType()), ("x_court_ft", DoubleType()), ("y_court_ft", DoubleType()),
    ("speed_mph", DoubleType()), ("acceleration", DoubleType()),
    ("distance_covered_ft", DoubleType()), ("heart_rate_bpm", DoubleType()),
)

GAME_STATS = _s(
    ("game_id", LongType()), ("player_id", LongType()), ("minutes_played", DoubleType()),
    ("points", IntegerType()), ("plus_minus", DoubleType()), ("shot_attempts", IntegerType()),
    ("shot_made", IntegerType()),
)

TEAM_SCHEDULES = _s(
    ("game_id", LongType()), ("date", DateType()), ("home_team", IntegerType()),
    ("away_team", IntegerType()), ("back_to_back", BooleanType()),
    ("travel_distance_miles", DoubleType()), ("rest_days_since_last_game", IntegerType()),
)

TRAINING_SESSIONS = _s(
    ("player_id", LongType()), ("date", StringType()), ("session_type", StringType()),
    ("intensity_score", DoubleType()), ("sleep_hours_prev_night", DoubleType()),
    ("duration_min", DoubleType()), ("heart_rate_avg", DoubleType()), ("heart_rate_max", DoubleType()),
)

INJURY_REPORTS = _s(
    ("player_id", LongType()), ("date", StringType()), ("games_missed", IntegerType()),
    ("treatment", StringType()), ("severity", StringType()),
)

# The telemetry message (JSON value of one stream record); ids are strings.
TELEMETRY = _s(
    ("game_id", StringType()), ("player_id", StringType()), ("team_id", StringType()),
    ("game_timestamp", StringType()), ("event_time", DoubleType()),
    ("x_court_ft", DoubleType()), ("y_court_ft", DoubleType()), ("speed_mph", DoubleType()),
    ("acceleration", DoubleType()), ("cumulative_distance", DoubleType()),
    ("heart_rate_bpm", DoubleType()),
)

DOMAIN = {
    "player_tracking": PLAYER_TRACKING,
    "game_stats": GAME_STATS,
    "team_schedules": TEAM_SCHEDULES,
    "training_sessions": TRAINING_SESSIONS,
    "injury_reports": INJURY_REPORTS,
}
