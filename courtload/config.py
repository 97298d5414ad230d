"""Fixed values and defaults.

Fixed values (must equal the reference's for the same results), stated
together in natural order:
  * heart-rate keep range for telemetry and cleaning checks: 60 .. 220 bpm
  * impossible-value gate: heart rate 40 .. 220 bpm, speed 0 .. 30 mph
  * rolling frame: 5 games (current row and 4 preceding)
  * workload tiers: 4 (ntile)
  * season profile cut points: 0.33 and 0.66 percentiles, labels
    "High Usage", "Mid Usage", "Low Usage"
  * travel buckets: < 500 "Short (<500mi)", < 1500 "Medium (500-1500mi)",
    else "Long (>1500mi)"
  * ratio tiers: <= 1 "Balanced (≤1:1)", <= 2 "Moderate (1-2:1)",
    else "High (>2:1)"
  * high-intensity week: average intensity > 6.5
  * injury horizon: 0 .. 7 days after the game
  * alert thresholds: heart rate 0.95 x max per-game average heart rate,
    distance 1.10 x average per-game distance; fallbacks 209.0 bpm and
    14520.0 ft
  * stream window 60 seconds, watermark 10 seconds
  * feet per mile 5280
  * injury defaults: games_missed 0, treatment "unknown", severity "unknown"
"""

from __future__ import annotations

from dataclasses import dataclass, field

HR_KEEP = (60.0, 220.0)
HR_POSSIBLE = (40.0, 220.0)
SPEED_POSSIBLE = (0.0, 30.0)

ROLLING_GAMES = 5
WORKLOAD_TIERS = 4

PROFILE_CUTS = (0.33, 0.66)
PROFILE_LABELS = ("High Usage", "Mid Usage", "Low Usage")

TRAVEL_EDGES = (500.0, 1500.0)
TRAVEL_LABELS = ("Short (<500mi)", "Medium (500-1500mi)", "Long (>1500mi)")

RATIO_EDGES = (1.0, 2.0)
RATIO_LABELS = ("Balanced (≤1:1)", "Moderate (1-2:1)", "High (>2:1)")

HIGH_INTENSITY = 6.5
HORIZON_DAYS = 7

HR_FACTOR = 0.95
DISTANCE_FACTOR = 1.10
HR_FALLBACK = 209.0
DISTANCE_FALLBACK = 14520.0

WINDOW = "60 seconds"
WATERMARK = "10 seconds"
FEET_PER_MILE = 5280

INCIDENT_DEFAULTS = {"games_missed": 0, "treatment": "unknown", "severity": "unknown"}

SESSION_TYPES = ("practice", "recovery", "gym", "film")

# Columns of the risk snapshot and the features correlated with its label.
SNAPSHOT = ("player_id", "date", "game_id", "rolling_5g_distance", "rolling_5g_avg_hr",
            "rolling_5g_minutes", "total_distance_ft", "avg_heart_rate", "total_minutes")
FEATURES = ("rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes",
            "avg_training_intensity", "avg_sleep_hours", "avg_travel_miles")


# The columns of the grouped readouts -- output name, aggregate, input column, digits.
MEASURES = {
    "training_load": (
        ("session_count", "count", "session_type", None),
        ("avg_intensity", "avg", "intensity_score", None),
        ("avg_sleep_hours", "avg", "sleep_hours_prev_night", None),
        ("avg_duration_min", "avg", "duration_min", None),
        ("avg_heart_rate", "avg", "heart_rate_avg", None)),
    "load_by_type": (
        ("avg_intensity", "avg", "avg_intensity", 2),
        ("avg_sleep_hours", "avg", "avg_sleep_hours", 1),
        ("avg_duration_min", "avg", "avg_duration_min", 1),
        ("avg_heart_rate", "avg", "avg_heart_rate", 1),
        ("total_sessions", "sum", "session_count", None)),
    "week": (
        ("avg_weekly_intensity", "avg", "intensity_score", None),
        ("avg_weekly_sleep", "avg", "sleep_hours_prev_night", None)),
    "intensity": (
        ("avg_plus_minus", "avg", "avg_plus_minus", 3),
        ("avg_shooting_pct", "avg", "shooting_pct", 2),
        ("avg_minutes", "avg", "total_minutes", 1),
        ("avg_practice_recovery_ratio", "avg", "practice_recovery_ratio", 2),
        ("avg_intensity", "avg", "avg_weekly_intensity", 2),
        ("total_records", "count", "player_id", None)),
    "ratio": (
        ("avg_plus_minus", "avg", "avg_plus_minus", 3),
        ("avg_shooting_pct", "avg", "shooting_pct", 2),
        ("avg_minutes", "avg", "total_minutes", 1),
        ("total_records", "count", "player_id", None)),
    "tier": (
        ("avg_shooting_pct", "avg", "shooting_pct", 2),
        ("avg_plus_minus", "avg", "avg_plus_minus", 3),
        ("avg_rolling_distance", "avg", "rolling_5g_distance", 1),
        ("avg_rolling_minutes", "avg", "rolling_5g_minutes", 1)),
    "rolling_mean": (
        ("avg_rolling_distance_ft", "avg", "rolling_5g_distance", 1),
        ("avg_rolling_hr", "avg", "rolling_5g_avg_hr", 1),
        ("avg_rolling_minutes", "avg", "rolling_5g_minutes", 1),
        ("games_played", "count", "game_id", None)),
    "training_mean": (
        ("avg_training_intensity", "avg", "intensity_score", None),
        ("avg_sleep_hours", "avg", "sleep_hours_prev_night", None),
        ("avg_travel_miles", "avg", "travel_distance_miles", None)),
    "league": (
        ("league_avg_plus_minus", "avg", "avg_plus_minus", 3),
        ("league_avg_shooting_pct", "avg", "shooting_pct", 2),
        ("league_avg_heart_rate", "avg", "avg_heart_rate", 2),
        ("league_avg_distance_ft", "avg", "avg_distance_ft", 2)),
    "rest_readout": (
        ("total_records", "count", "player_id", None),
        ("avg_plus_minus", "avg", "avg_plus_minus", 2),
        ("avg_minutes", "avg", "avg_minutes", 1),
        ("avg_distance_ft", "avg", "avg_distance_ft", 1),
        ("avg_heart_rate", "avg", "avg_heart_rate", 1),
        ("shooting_pct", "avg", "shooting_pct", 1)),
    "impact": (
        ("total_players", "count", "player_id", None),
        ("avg_btb_impact", "avg", "btb_impact", 3),
        ("stddev_btb_impact", "stddev", "btb_impact", 3),
        ("worst_impact", "min", "btb_impact", 3),
        ("best_impact", "max", "btb_impact", 3)),
    "profile": (
        ("avg_plus_minus", "avg", "avg_plus_minus", 3),
        ("avg_shooting_pct", "avg", "shooting_pct", 2),
        ("avg_distance_ft", "avg", "avg_distance_ft", 1),
        ("player_count", "count", "player_id", None)),
}
WEEK_PERFORMANCE = ("avg_plus_minus", "shooting_pct", "total_minutes")

# Logical dataset names of the batch job (processed and analytics zones).
PROCESSED_OUTPUTS = ("tracking_with_stats", "training_with_schedule", "tracking_stats_schedule")
GATED_OUTPUTS = PROCESSED_OUTPUTS + (
    "rolling_workload", "back_to_back_analysis", "travel_rest_analysis", "training_load_analysis",
)


@dataclass(frozen=True)
class Zones:
    """Directory layout of the data lake (raw / processed / analytics)."""

    root: str
    raw: str = field(default="raw")
    processed: str = field(default="processed")
    analytics: str = field(default="analytics")
    checkpoints: str = field(default="checkpoints")

    def path(self, zone: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, zone)}/{name}"
