"""DuckDB SQL oracle for the registered queries.

The oracle states the reference semantics literally and independently of
the Spark plans: the many-to-many join is materialised, the rolling frame
and ntile are SQL windows, the horizon label is the player-only join with a
datediff flag, the schedule join uses the OR condition.  The adapters of
FIXTURES.md are repeated as CTEs over the pre-registered driver tables.

Spark rounds doubles HALF_UP on their shortest decimal form; ``hu`` gives
DuckDB the same rule.
"""

from __future__ import annotations


def hu(expr: str, digits: int) -> str:
    """round(expr, digits) HALF_UP on the shortest decimal form, snapped to 1e-9 first (``sround``)."""
    return f"CAST(round(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), 9), {digits}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / nullif(CAST(({den}) AS DOUBLE), 0))"


SHIFTED_DATE = ("CASE WHEN event_id % 97 = 0 THEN 'not-a-date' "
                "ELSE strftime(CAST(ts AS DATE) - 8766, '%Y-%m-%d') END")

ADAPTERS = f"""
tracking AS (
  SELECT l.l_orderkey AS game_id, l.l_suppkey AS player_id, s.s_nationkey AS team_id,
         l.l_shipdate AS "timestamp", l.l_discount * 940 AS x_court_ft, l.l_tax * 625 AS y_court_ft,
         l.l_quantity / 2 AS speed_mph, (l.l_discount - l.l_tax) * 100 AS acceleration,
         l.l_quantity * 10 AS distance_covered_ft,
         40 + 200 * (l.l_extendedprice - 1) / 110000 AS heart_rate_bpm
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
stats AS (
  SELECT l_orderkey AS game_id, l_suppkey AS player_id, l_quantity / 5 AS minutes_played,
         l_linenumber AS points, l_tax * 100 - 4 AS plus_minus,
         CAST(l_quantity AS INTEGER) AS shot_attempts,
         CAST(floor(l_quantity * (0.4 + l_discount)) AS INTEGER) AS shot_made
  FROM lineitem),
schedule AS (
  SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS "date", c.c_nationkey AS home_team,
         CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS INTEGER) AS away_team,
         o.o_orderpriority = '1-URGENT' AS back_to_back, o.o_totalprice / 200 AS travel_distance_miles,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 1 AS rest_days_since_last_game
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
training_raw AS (
  SELECT user_id AS player_id, {SHIFTED_DATE} AS "date",
         CASE event_type WHEN 'click' THEN 'practice' WHEN 'view' THEN 'gym'
              WHEN 'purchase' THEN 'recovery' WHEN 'signup' THEN 'film' END AS session_type,
         value / 10 AS intensity_score, 5 + (event_id % 41) / 10 AS sleep_hours_prev_night,
         CAST(30 + event_id % 91 AS DOUBLE) AS duration_min, 55 + value / 4 AS heart_rate_avg,
         55 + value / 4 + event_id % 60 AS heart_rate_max
  FROM events WHERE event_type <> 'error'),
training AS (
  SELECT player_id, TRY_CAST("date" AS DATE) AS "date", session_type, intensity_score,
         sleep_hours_prev_night, duration_min, heart_rate_avg, heart_rate_max
  FROM training_raw),
incidents_raw AS (
  SELECT user_id AS player_id, {SHIFTED_DATE} AS "date",
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(floor(value / 20) AS INTEGER) END AS games_missed,
         CASE WHEN event_id % 3 = 0 THEN NULL WHEN value >= 200 THEN 'surgery'
              WHEN value >= 50 THEN 'physio' ELSE 'rest' END AS treatment,
         CASE WHEN event_id % 5 = 0 THEN NULL WHEN value >= 300 THEN 'severe'
              WHEN value >= 100 THEN 'moderate' ELSE 'minor' END AS severity
  FROM events WHERE event_type = 'error'),
incidents AS (
  SELECT player_id, TRY_CAST("date" AS DATE) AS injury_date, coalesce(games_missed, 0) AS games_missed,
         coalesce(treatment, 'unknown') AS treatment, coalesce(severity, 'unknown') AS severity
  FROM incidents_raw),
telemetry AS (
  SELECT json_extract_string(props, '$.k') AS game_id, CAST(user_id AS VARCHAR) AS player_id,
         CAST(user_id % 25 AS VARCHAR) AS team_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS game_timestamp,
         epoch_us(ts) / 1e6 AS event_time, CAST(event_id % 95 AS DOUBLE) AS x_court_ft,
         CAST(event_id % 51 AS DOUBLE) AS y_court_ft, value / 20 AS speed_mph, value / 100 - 2 AS acceleration,
         value * 10 AS cumulative_distance, value AS heart_rate_bpm
  FROM events)"""

# The literal reference chain over the adapters.
CHAIN = f"""
tws AS (SELECT * FROM tracking JOIN stats USING (game_id, player_id)),
tss AS (SELECT * FROM tws LEFT JOIN schedule USING (game_id)),
pgw AS (
  SELECT player_id, team_id, game_id, "date",
         sum(distance_covered_ft) AS total_distance_ft, avg(heart_rate_bpm) AS avg_heart_rate,
         sum(minutes_played) AS total_minutes, avg(speed_mph) AS avg_speed,
         CAST(sum(points) AS BIGINT) AS total_points, avg(plus_minus) AS avg_plus_minus,
         CAST(sum(shot_attempts) AS BIGINT) AS total_shot_attempts,
         CAST(sum(shot_made) AS BIGINT) AS total_shot_made,
         {hu(div('sum(shot_made)', 'sum(shot_attempts)') + ' * 100', 2)} AS shooting_pct
  FROM tss GROUP BY player_id, team_id, game_id, "date"),
rolling AS (
  SELECT *, sum(total_distance_ft) OVER w AS rolling_5g_distance,
         avg(avg_heart_rate) OVER w AS rolling_5g_avg_hr,
         sum(total_minutes) OVER w AS rolling_5g_minutes
  FROM pgw
  WINDOW w AS (PARTITION BY player_id ORDER BY "date" ASC NULLS FIRST, game_id, team_id ASC NULLS FIRST
               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""

PREFIX = "WITH " + ADAPTERS.strip() + ",\n" + CHAIN.strip()

ORACLE: dict[str, str] = {}


def q(name: str, final: str, doubles: list[str] | tuple[str, ...] = (), extra: str = "") -> None:
    """Register ``final`` (a SELECT over the CTEs) with doubles rounded to 6 places."""
    head = PREFIX + ((",\n" + extra.strip()) if extra.strip() else "")
    if doubles:
        repl = ", ".join(f"{hu(c, 6)} AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({repl}) FROM (\n{final}\n) AS q_"
    else:
        body = final
    ORACLE[name] = head + "\n" + body


PGW_DOUBLES = ["total_distance_ft", "avg_heart_rate", "total_minutes", "avg_speed", "avg_plus_minus", "shooting_pct"]

q("join_tracking_stats", """
SELECT t.game_id, t.player_id, t.team_id, t.tracking_rows, s.stats_rows, j.pair_rows,
       j.joined_distance_ft, j.joined_minutes
FROM (SELECT game_id, player_id, team_id, count(*) AS tracking_rows FROM tracking GROUP BY ALL) t
JOIN (SELECT game_id, player_id, count(*) AS stats_rows FROM stats GROUP BY ALL) s USING (game_id, player_id)
JOIN (SELECT game_id, player_id, team_id, count(*) AS pair_rows, sum(distance_covered_ft) AS joined_distance_ft,
             sum(minutes_played) AS joined_minutes FROM tws GROUP BY ALL) j USING (game_id, player_id, team_id)
""", ["joined_distance_ft", "joined_minutes"])

q("player_game_workload", "SELECT * FROM pgw", PGW_DOUBLES)

for _name in ("rolling_workload", "incremental_rolling_workload"):
    q(_name, "SELECT * FROM rolling", PGW_DOUBLES + ["rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes"])

# ---- literal reference CTEs used by several queries ---------------------------------------
def _pct(made: str, att: str, d: int = 2) -> str:
    return hu(div(made, att) + " * 100", d)


BTB = f"""
btb AS (
  SELECT player_id, team_id, back_to_back, count(game_id) AS games_played, avg(plus_minus) AS avg_plus_minus,
         avg(minutes_played) AS avg_minutes, avg(distance_covered_ft) AS avg_distance_ft,
         avg(heart_rate_bpm) AS avg_heart_rate, {_pct('sum(shot_made)', 'sum(shot_attempts)')} AS shooting_pct
  FROM tss GROUP BY player_id, team_id, back_to_back),
btb_pivot AS (
  SELECT player_id,
         arg_min(avg_plus_minus, team_id) FILTER (WHERE back_to_back = false) AS normal_rest_pm,
         arg_min(avg_plus_minus, team_id) FILTER (WHERE back_to_back = true) AS btb_pm
  FROM btb GROUP BY player_id),
res AS (
  SELECT *, CASE WHEN btb_impact >= 0 THEN 'Resilient' ELSE 'Declines' END AS resilient
  FROM (SELECT *, {hu('btb_pm - normal_rest_pm', 3)} AS btb_impact FROM btb_pivot) AS p_)"""

PROFILE = """
season AS (
  SELECT player_id, sum(total_distance_ft) AS season_total_distance, avg(total_minutes) AS season_avg_minutes
  FROM pgw GROUP BY player_id),
cuts AS (
  SELECT quantile_disc(season_total_distance, 0.33) AS p33, quantile_disc(season_total_distance, 0.66) AS p66
  FROM season),
profile AS (
  SELECT s.*, CASE WHEN s.season_total_distance > c.p66 THEN 'High Usage'
                   WHEN s.season_total_distance > c.p33 THEN 'Mid Usage' ELSE 'Low Usage' END AS workload_profile
  FROM season s, cuts c)"""

TRAINING = f"""
bridge AS (SELECT DISTINCT player_id, team_id FROM tracking),
tteam AS (SELECT t.*, b.team_id FROM training t LEFT JOIN bridge b USING (player_id)),
tsched AS (
  SELECT tt.*, s.game_id, s.home_team, s.away_team, s.back_to_back, s.travel_distance_miles,
         s.rest_days_since_last_game
  FROM tteam tt LEFT JOIN schedule s
    ON tt."date" = s."date" AND (tt.team_id = s.home_team OR tt.team_id = s.away_team)),
tload AS (
  SELECT player_id, session_type, count(session_type) AS session_count, avg(intensity_score) AS avg_intensity,
         avg(sleep_hours_prev_night) AS avg_sleep_hours, avg(duration_min) AS avg_duration_min,
         avg(heart_rate_avg) AS avg_heart_rate
  FROM tsched GROUP BY player_id, session_type),
weekly0 AS (
  SELECT player_id, CAST(date_trunc('week', "date") AS DATE) AS week,
         CAST(sum(CASE WHEN session_type = 'practice' THEN 1 ELSE 0 END) AS BIGINT) AS practice_count,
         CAST(sum(CASE WHEN session_type = 'recovery' THEN 1 ELSE 0 END) AS BIGINT) AS recovery_count,
         CAST(sum(CASE WHEN session_type = 'gym' THEN 1 ELSE 0 END) AS BIGINT) AS gym_count,
         CAST(sum(CASE WHEN session_type = 'film' THEN 1 ELSE 0 END) AS BIGINT) AS film_count,
         avg(intensity_score) AS avg_weekly_intensity, avg(sleep_hours_prev_night) AS avg_weekly_sleep
  FROM training GROUP BY ALL),
weekly AS (
  SELECT *, {hu('practice_count / CASE WHEN recovery_count = 0 THEN 1 ELSE recovery_count END', 2)}
              AS practice_recovery_ratio,
         CASE WHEN avg_weekly_intensity > 6.5 THEN 1 ELSE 0 END AS high_intensity_week
  FROM weekly0),
wperf AS (
  SELECT w.*, g.avg_plus_minus, g.shooting_pct, g.total_minutes
  FROM weekly w JOIN (SELECT player_id, CAST(date_trunc('week', "date") AS DATE) AS week, avg_plus_minus,
                             shooting_pct, total_minutes FROM pgw) g USING (player_id, week)),
tsummary AS (
  SELECT player_id, avg(intensity_score) AS avg_training_intensity, avg(sleep_hours_prev_night) AS avg_sleep_hours,
         avg(travel_distance_miles) AS avg_travel_miles
  FROM tsched GROUP BY player_id)"""

SNAP_COLS = ("player_id, \"date\", game_id, rolling_5g_distance, rolling_5g_avg_hr, rolling_5g_minutes, "
             "total_distance_ft, avg_heart_rate, total_minutes")
RISK = f"""
snap AS (
  SELECT {SNAP_COLS} FROM (
    SELECT {SNAP_COLS}, row_number() OVER (PARTITION BY player_id, game_id
           ORDER BY "date" NULLS FIRST, rolling_5g_distance NULLS FIRST, rolling_5g_avg_hr NULLS FIRST) AS rn_
    FROM rolling) AS r_ WHERE rn_ = 1),
labeled AS (
  SELECT s.player_id, s."date", s.game_id, s.rolling_5g_distance, s.rolling_5g_avg_hr, s.rolling_5g_minutes,
         s.total_distance_ft, s.avg_heart_rate, s.total_minutes,
         max(CASE WHEN datediff('day', s."date", i.injury_date) BETWEEN 0 AND 7 THEN 1 ELSE 0 END)
           AS injury_within_7_days
  FROM snap s LEFT JOIN incidents i ON s.player_id = i.player_id
  GROUP BY ALL),
features AS (SELECT * FROM labeled LEFT JOIN tsummary USING (player_id))"""

BTB_D = ["avg_plus_minus", "avg_minutes", "avg_distance_ft", "avg_heart_rate", "shooting_pct"]
ROLL_D = PGW_DOUBLES + ["rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes"]
SNAP_D = ["rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes", "total_distance_ft",
          "avg_heart_rate", "total_minutes"]
TRACK_D = ["x_court_ft", "y_court_ft", "speed_mph", "acceleration", "distance_covered_ft", "heart_rate_bpm"]
TRAIN_D = ["intensity_score", "sleep_hours_prev_night", "duration_min", "heart_rate_avg", "heart_rate_max"]

# ---- cleaning and profiles ------------------------------------------------------------------
q("clean_heart_rate", "SELECT * FROM tracking WHERE heart_rate_bpm BETWEEN 60 AND 220", TRACK_D)

q("out_of_range_counts", """
SELECT 'player_tracking' AS "table", 'heart_rate_bpm' AS "column", 60.0::DOUBLE AS lo, 220.0::DOUBLE AS hi,
       count(*) FILTER (WHERE heart_rate_bpm < 60 OR heart_rate_bpm > 220) AS out_of_range,
       count(heart_rate_bpm) AS checked FROM tracking
UNION ALL
SELECT 'training_sessions', 'heart_rate_avg', 60.0, 220.0,
       count(*) FILTER (WHERE heart_rate_avg < 60 OR heart_rate_avg > 220), count(heart_rate_avg) FROM training_raw
UNION ALL
SELECT 'training_sessions', 'heart_rate_max', 60.0, 220.0,
       count(*) FILTER (WHERE heart_rate_max < 60 OR heart_rate_max > 220), count(heart_rate_max) FROM training_raw
""")

q("clean_dates", "SELECT * FROM training", TRAIN_D)
q("clean_incidents", "SELECT * FROM incidents")

RAW_COLS = {
    "player_tracking": ("tracking", ["game_id", "player_id", "team_id", "timestamp", "x_court_ft", "y_court_ft",
                                     "speed_mph", "acceleration", "distance_covered_ft", "heart_rate_bpm"]),
    "game_stats": ("stats", ["game_id", "player_id", "minutes_played", "points", "plus_minus", "shot_attempts",
                             "shot_made"]),
    "injury_reports": ("incidents_raw", ["player_id", "date", "games_missed", "treatment", "severity"]),
    "training_sessions": ("training_raw", ["player_id", "date", "session_type", "intensity_score",
                                           "sleep_hours_prev_night", "duration_min", "heart_rate_avg",
                                           "heart_rate_max"]),
    "team_schedules": ("schedule", ["game_id", "date", "home_team", "away_team", "back_to_back",
                                    "travel_distance_miles", "rest_days_since_last_game"]),
}
q("null_profile", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM {v}"
    for t, (v, cols) in RAW_COLS.items() for c in cols))

DESCRIBE_COLS = {
    "player_tracking": ("tracking", ["heart_rate_bpm", "x_court_ft", "y_court_ft"]),
    "training_sessions": ("training_raw", ["heart_rate_avg", "heart_rate_max", "intensity_score",
                                           "sleep_hours_prev_night"]),
    "team_schedules": ("schedule", ["travel_distance_miles", "rest_days_since_last_game"]),
}
q("describe_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", avg(CAST({c} AS DOUBLE)) AS mean, "
    f"stddev_samp(CAST({c} AS DOUBLE)) AS stddev, min(CAST({c} AS DOUBLE)) AS \"min\", "
    f"max(CAST({c} AS DOUBLE)) AS \"max\", '{t}' AS \"table\" FROM {v}"
    for t, (v, cols) in DESCRIBE_COLS.items() for c in cols), ["mean", "stddev", "min", "max"])

q("table_census", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", {len(cols)} AS \"columns\" FROM {v}"
    for t, (v, cols) in RAW_COLS.items()))

q("player_team_map", "SELECT DISTINCT player_id, team_id FROM tracking")
q("dedupe_snapshot", "SELECT * FROM snap", SNAP_D, extra=TRAINING + "," + RISK)

# ---- joins ------------------------------------------------------------------------------------
q("join_training_by_date", """
SELECT s."date", s.sessions, coalesce(g.games, 0) AS games,
       s.sessions * greatest(coalesce(g.games, 0), 1) AS joined_rows
FROM (SELECT "date", count(*) AS sessions FROM training GROUP BY "date") s
LEFT JOIN (SELECT "date", count(*) AS games FROM schedule WHERE "date" IS NOT NULL GROUP BY "date") g
  ON s."date" = g."date"
""")
q("join_training_team", "SELECT * FROM tteam", TRAIN_D, extra=TRAINING)
q("join_training_schedule", "SELECT * FROM tsched", TRAIN_D + ["travel_distance_miles"], extra=TRAINING)
q("join_schedule_context", """
SELECT game_id, player_id, team_id, count(*) AS pair_rows, "date", back_to_back, travel_distance_miles,
       rest_days_since_last_game
FROM tss GROUP BY game_id, player_id, team_id, "date", back_to_back, travel_distance_miles, rest_days_since_last_game
""", ["travel_distance_miles"])
q("join_week_performance", "SELECT * FROM wperf",
  ["avg_weekly_intensity", "avg_weekly_sleep", "practice_recovery_ratio", "avg_plus_minus", "shooting_pct",
   "total_minutes"], extra=TRAINING)
q("horizon_label", "SELECT * FROM labeled", SNAP_D, extra=TRAINING + "," + RISK)
q("coverage_gaps_clean", """
SELECT s.game_id, s.player_id, count(*) AS expected_rows FROM stats s
WHERE NOT EXISTS (SELECT 1 FROM tracking t WHERE t.game_id = s.game_id AND t.player_id = s.player_id
                  AND t.heart_rate_bpm BETWEEN 60 AND 220)
GROUP BY s.game_id, s.player_id
""")
q("coverage_gaps", """
SELECT s.game_id, s.player_id, count(*) AS expected_rows FROM stats s
WHERE NOT EXISTS (SELECT 1 FROM tracking t WHERE t.game_id = s.game_id AND t.player_id = s.player_id)
GROUP BY s.game_id, s.player_id
""")

# ---- workload / impact ----------------------------------------------------------------------
q("workload_tiers", f"""
SELECT workload_tier, {hu('avg(shooting_pct)', 2)} AS avg_shooting_pct, {hu('avg(avg_plus_minus)', 3)} AS avg_plus_minus,
       {hu('avg(rolling_5g_distance)', 1)} AS avg_rolling_distance, {hu('avg(rolling_5g_minutes)', 1)} AS avg_rolling_minutes
FROM (SELECT *, CAST(ntile(4) OVER (ORDER BY rolling_5g_distance NULLS FIRST, player_id NULLS FIRST,
                                    game_id NULLS FIRST, team_id NULLS FIRST, "date" NULLS FIRST) AS INTEGER)
                 AS workload_tier FROM rolling) AS t_
GROUP BY workload_tier
""", ["avg_shooting_pct", "avg_plus_minus", "avg_rolling_distance", "avg_rolling_minutes"])

q("back_to_back_analysis", "SELECT * FROM btb", BTB_D, extra=BTB)
q("back_to_back_summary", f"""
SELECT back_to_back, {hu('avg(avg_plus_minus)', 3)} AS league_avg_plus_minus,
       {hu('avg(shooting_pct)', 2)} AS league_avg_shooting_pct, {hu('avg(avg_heart_rate)', 2)} AS league_avg_heart_rate,
       {hu('avg(avg_distance_ft)', 2)} AS league_avg_distance_ft
FROM btb GROUP BY back_to_back
""", ["league_avg_plus_minus", "league_avg_shooting_pct", "league_avg_heart_rate", "league_avg_distance_ft"], extra=BTB)
q("back_to_back_readout", f"""
SELECT back_to_back, count(player_id) AS total_records, {hu('avg(avg_plus_minus)', 2)} AS avg_plus_minus,
       {hu('avg(avg_minutes)', 1)} AS avg_minutes, {hu('avg(avg_distance_ft)', 1)} AS avg_distance_ft,
       {hu('avg(avg_heart_rate)', 1)} AS avg_heart_rate, {hu('avg(shooting_pct)', 1)} AS shooting_pct
FROM btb GROUP BY back_to_back
""", BTB_D, extra=BTB)
q("back_to_back_pivot", "SELECT * FROM btb_pivot", ["normal_rest_pm", "btb_pm"], extra=BTB)
q("resilience_split", "SELECT resilient, count(*) AS \"count\" FROM res GROUP BY resilient", extra=BTB)
q("resilience_extremes", """
(SELECT *, 'most_affected' AS direction FROM res ORDER BY btb_impact ASC NULLS LAST, player_id LIMIT 5)
UNION ALL
(SELECT *, 'most_resilient' AS direction FROM res ORDER BY btb_impact DESC NULLS LAST, player_id LIMIT 5)
""", ["normal_rest_pm", "btb_pm", "btb_impact"], extra=BTB)
q("resilience_stats", f"""
SELECT count(player_id) AS total_players,
       CAST(sum(CASE WHEN resilient = 'Resilient' THEN 1 ELSE 0 END) AS BIGINT) AS resilient_count,
       CAST(sum(CASE WHEN resilient = 'Declines' THEN 1 ELSE 0 END) AS BIGINT) AS decline_count,
       {hu('avg(btb_impact)', 3)} AS avg_btb_impact, {hu('stddev_samp(btb_impact)', 3)} AS stddev_btb_impact,
       {hu('min(btb_impact)', 3)} AS worst_impact, {hu('max(btb_impact)', 3)} AS best_impact
FROM res
""", ["avg_btb_impact", "stddev_btb_impact", "worst_impact", "best_impact"], extra=BTB)
q("season_profile", "SELECT * FROM profile", ["season_total_distance", "season_avg_minutes"], extra=PROFILE)
q("btb_by_profile", f"""
SELECT p.workload_profile, b.back_to_back, {hu('avg(b.avg_plus_minus)', 3)} AS avg_plus_minus,
       {hu('avg(b.shooting_pct)', 2)} AS avg_shooting_pct, {hu('avg(b.avg_distance_ft)', 1)} AS avg_distance_ft,
       count(b.player_id) AS player_count
FROM btb b LEFT JOIN profile p USING (player_id) GROUP BY p.workload_profile, b.back_to_back
""", ["avg_plus_minus", "avg_shooting_pct", "avg_distance_ft"], extra=BTB + "," + PROFILE)

TRAVEL_REST = f"""
travel_rest AS (
  SELECT rest_days_since_last_game, back_to_back, count(game_id) AS total_records,
         avg(heart_rate_bpm) AS avg_heart_rate, avg(distance_covered_ft) AS avg_distance_ft,
         avg(plus_minus) AS avg_plus_minus, avg(travel_distance_miles) AS avg_travel_miles,
         {_pct('sum(shot_made)', 'sum(shot_attempts)')} AS shooting_pct
  FROM tss GROUP BY rest_days_since_last_game, back_to_back)"""
q("travel_rest_analysis", "SELECT * FROM travel_rest",
  ["avg_heart_rate", "avg_distance_ft", "avg_plus_minus", "avg_travel_miles", "shooting_pct"], extra=TRAVEL_REST)
q("travel_bucket_analysis", f"""
SELECT travel_bucket, rest_days_since_last_game, {hu('avg(plus_minus)', 3)} AS avg_plus_minus,
       {hu('avg(heart_rate_bpm)', 2)} AS avg_heart_rate, {_pct('sum(shot_made)', 'sum(shot_attempts)')} AS shooting_pct,
       count(game_id) AS total_records
FROM (SELECT *, CASE WHEN travel_distance_miles < 500 THEN 'Short (<500mi)'
                     WHEN travel_distance_miles < 1500 THEN 'Medium (500-1500mi)' ELSE 'Long (>1500mi)' END
                  AS travel_bucket FROM tss) AS t_
GROUP BY travel_bucket, rest_days_since_last_game
""", ["avg_plus_minus", "avg_heart_rate", "shooting_pct"])
q("travel_correlations", """
SELECT corr(travel_distance_miles, plus_minus) AS travel_vs_plusminus,
       corr(travel_distance_miles, heart_rate_bpm) AS travel_vs_heartrate,
       corr(rest_days_since_last_game, plus_minus) AS rest_vs_plusminus
FROM tss
""", ["travel_vs_plusminus", "travel_vs_heartrate", "rest_vs_plusminus"])
q("player_thresholds", f"""
SELECT player_id, {hu('max(avg_heart_rate) * 0.95', 1)} AS hr_alert_threshold,
       {hu('avg(total_distance_ft) * 1.10', 1)} AS distance_alert_threshold
FROM rolling GROUP BY player_id
""", ["hr_alert_threshold", "distance_alert_threshold"])
q("top_workload", f"""
SELECT player_id, {hu('avg(rolling_5g_distance)', 1)} AS avg_rolling_distance_ft,
       {hu('avg(rolling_5g_avg_hr)', 1)} AS avg_rolling_hr, {hu('avg(rolling_5g_minutes)', 1)} AS avg_rolling_minutes,
       count(game_id) AS games_played
FROM rolling GROUP BY player_id ORDER BY avg_rolling_distance_ft DESC NULLS LAST, player_id LIMIT 10
""", ["avg_rolling_distance_ft", "avg_rolling_hr", "avg_rolling_minutes"])
q("readout_back_to_back", f"""
SELECT back_to_back, games_played, {hu('avg_plus_minus', 2)} AS avg_plus_minus, {hu('avg_minutes', 1)} AS avg_minutes,
       {hu('avg_distance_ft', 1)} AS avg_distance_ft, {hu('avg_heart_rate', 1)} AS avg_heart_rate,
       {hu('shooting_pct', 1)} AS shooting_pct
FROM btb
""", BTB_D, extra=BTB)
q("readout_travel_rest", f"""
SELECT rest_days_since_last_game, back_to_back, total_records, {hu('avg_heart_rate', 1)} AS avg_heart_rate,
       {hu('avg_distance_ft', 1)} AS avg_distance_ft, {hu('avg_plus_minus', 2)} AS avg_plus_minus,
       {hu('avg_travel_miles', 1)} AS avg_travel_miles, {hu('shooting_pct', 1)} AS shooting_pct
FROM travel_rest
""", ["avg_heart_rate", "avg_distance_ft", "avg_plus_minus", "avg_travel_miles", "shooting_pct"], extra=TRAVEL_REST)

# ---- training -------------------------------------------------------------------------------
q("training_load_analysis", "SELECT * FROM tload",
  ["avg_intensity", "avg_sleep_hours", "avg_duration_min", "avg_heart_rate"], extra=TRAINING)
q("training_load_by_type", f"""
SELECT session_type, {hu('avg(avg_intensity)', 2)} AS avg_intensity, {hu('avg(avg_sleep_hours)', 1)} AS avg_sleep_hours,
       {hu('avg(avg_duration_min)', 1)} AS avg_duration_min, {hu('avg(avg_heart_rate)', 1)} AS avg_heart_rate,
       CAST(sum(session_count) AS BIGINT) AS total_sessions
FROM tload GROUP BY session_type
""", ["avg_intensity", "avg_sleep_hours", "avg_duration_min", "avg_heart_rate"], extra=TRAINING)
q("weekly_training", "SELECT * FROM weekly", ["avg_weekly_intensity", "avg_weekly_sleep", "practice_recovery_ratio"],
  extra=TRAINING)
q("intensity_performance", f"""
SELECT high_intensity_week, {hu('avg(avg_plus_minus)', 3)} AS avg_plus_minus, {hu('avg(shooting_pct)', 2)} AS avg_shooting_pct,
       {hu('avg(total_minutes)', 1)} AS avg_minutes, {hu('avg(practice_recovery_ratio)', 2)} AS avg_practice_recovery_ratio,
       {hu('avg(avg_weekly_intensity)', 2)} AS avg_intensity, count(player_id) AS total_records
FROM wperf GROUP BY high_intensity_week
""", ["avg_plus_minus", "avg_shooting_pct", "avg_minutes", "avg_practice_recovery_ratio", "avg_intensity"],
  extra=TRAINING)
q("ratio_performance", f"""
SELECT ratio_tier, {hu('avg(avg_plus_minus)', 3)} AS avg_plus_minus, {hu('avg(shooting_pct)', 2)} AS avg_shooting_pct,
       {hu('avg(total_minutes)', 1)} AS avg_minutes, count(player_id) AS total_records
FROM (SELECT *, CASE WHEN practice_recovery_ratio <= 1 THEN 'Balanced (≤1:1)'
                     WHEN practice_recovery_ratio <= 2 THEN 'Moderate (1-2:1)' ELSE 'High (>2:1)' END AS ratio_tier
      FROM wperf) AS t_
GROUP BY ratio_tier
""", ["avg_plus_minus", "avg_shooting_pct", "avg_minutes"], extra=TRAINING)

# ---- risk -----------------------------------------------------------------------------------
FEAT_D = SNAP_D + ["avg_training_intensity", "avg_sleep_hours", "avg_travel_miles"]
q("injury_risk_features", "SELECT * FROM features", FEAT_D, extra=TRAINING + "," + RISK)
q("training_summary", "SELECT * FROM tsummary", ["avg_training_intensity", "avg_sleep_hours", "avg_travel_miles"],
  extra=TRAINING)
q("incident_dates", """
SELECT player_id, injury_date, count(*) AS incidents FROM incidents WHERE injury_date IS NOT NULL
GROUP BY player_id, injury_date
""")
q("risk_feature_correlations", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CASE WHEN isnan(corr({c}, injury_within_7_days)) THEN NULL "
    f"ELSE corr({c}, injury_within_7_days) END AS correlation FROM features"
    for c in ("rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes", "avg_training_intensity",
              "avg_sleep_hours", "avg_travel_miles")), ["correlation"], extra=TRAINING + "," + RISK)
q("risk_label_balance", "SELECT injury_within_7_days, count(*) AS \"count\" FROM features GROUP BY 1",
  extra=TRAINING + "," + RISK)
q("incident_frequency_by_tier", f"""
SELECT workload_profile, count(player_id) AS players, CAST(sum(coalesce(incidents, 0)) AS BIGINT) AS incidents,
       CAST(sum(CASE WHEN incidents > 0 THEN 1 ELSE 0 END) AS BIGINT) AS injured_players,
       {hu(div('sum(CASE WHEN incidents > 0 THEN 1 ELSE 0 END)', 'count(player_id)'), 4)} AS injury_rate,
       {hu(div('sum(coalesce(incidents, 0))', 'count(player_id)'), 4)} AS incidents_per_player
FROM (SELECT p.player_id, p.workload_profile, i.incidents FROM profile p
      LEFT JOIN (SELECT player_id, count(*) AS incidents FROM incidents GROUP BY player_id) i USING (player_id)) AS t_
GROUP BY workload_profile
""", ["injury_rate", "incidents_per_player"], extra=PROFILE)

# ---- gates ------------------------------------------------------------------------------------
q("gate_inputs", "\nUNION ALL\n".join(
    f"SELECT 'inputs_present' AS \"check\", '{t}' AS subject, count(*) AS \"rows\", "
    f"CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failures, count(*) > 0 AS passed FROM {v}"
    for t, (v, _) in RAW_COLS.items()))
q("gate_impossible_values", """
SELECT 'impossible_values' AS "check", 'heart_rate_bpm' AS subject, count(heart_rate_bpm) AS "rows",
       count(*) FILTER (WHERE heart_rate_bpm < 40 OR heart_rate_bpm > 220) AS failures,
       count(*) FILTER (WHERE heart_rate_bpm < 40 OR heart_rate_bpm > 220) = 0 AS passed FROM tracking
UNION ALL
SELECT 'impossible_values', 'speed_mph', count(speed_mph),
       count(*) FILTER (WHERE speed_mph < 0 OR speed_mph > 30),
       count(*) FILTER (WHERE speed_mph < 0 OR speed_mph > 30) = 0 FROM tracking
""")
q("gate_input_tables", "\nUNION ALL\n".join(
    f"SELECT 'inputs_present' AS \"check\", '{t}' AS subject, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failures, "
    f"count(*) > 0 AS passed FROM {t}" for t in ("lineitem", "supplier", "orders", "customer", "events"))
  + "\nUNION ALL SELECT 'inputs_present', 'wearables', CAST(1 AS BIGINT), FALSE")
q("schedule_gaps", """
SELECT s.game_id, count(*) AS expected_rows FROM schedule s
WHERE NOT EXISTS (SELECT 1 FROM tracking t WHERE t.game_id = s.game_id) GROUP BY s.game_id
""")
q("gate_schedule_completeness", """
SELECT 'tracking_completeness' AS "check", 'team_schedules' AS subject, count(*) AS failures, count(*) = 0 AS passed
FROM (SELECT DISTINCT game_id FROM schedule) s WHERE NOT EXISTS (SELECT 1 FROM tracking t WHERE t.game_id = s.game_id)
""")
q("gate_completeness", """
SELECT 'tracking_completeness' AS "check", 'game_stats' AS subject, count(*) AS failures, count(*) = 0 AS passed
FROM (SELECT DISTINCT game_id, player_id FROM stats) s
WHERE NOT EXISTS (SELECT 1 FROM tracking t WHERE t.game_id = s.game_id AND t.player_id = s.player_id)
""")

# ---- telemetry ---------------------------------------------------------------------------------
TELE = f"""
tdec AS (
  SELECT *, make_timestamp(CAST(floor(event_time) AS BIGINT) * 1000000) AS event_timestamp
  FROM telemetry WHERE heart_rate_bpm BETWEEN 60 AND 220),
texe AS (
  SELECT make_timestamp(w_ * 60000000) AS window_start, make_timestamp((w_ + 1) * 60000000) AS window_end,
         player_id, team_id, game_id, {hu('avg(heart_rate_bpm)', 1)} AS avg_heart_rate,
         {hu('max(heart_rate_bpm)', 1)} AS max_heart_rate, {hu('sum(cumulative_distance)', 1)} AS total_distance_ft,
         {hu('avg(speed_mph)', 2)} AS avg_speed_mph, count(*) AS tracking_frames
  FROM (SELECT *, CAST(floor(floor(event_time) / 60) AS BIGINT) AS w_ FROM tdec) AS d_
  GROUP BY w_, player_id, team_id, game_id),
thr AS (
  SELECT CAST(player_id AS VARCHAR) AS player_id, {hu('max(avg_heart_rate) * 0.95', 1)} AS hr_alert_threshold,
         {hu('avg(total_distance_ft) * 1.10', 1)} AS distance_alert_threshold
  FROM rolling GROUP BY player_id),
talerts AS (
  SELECT *, heart_rate_alert OR distance_alert AS fatigue_alert FROM (
    SELECT *, avg_heart_rate >= hr_alert_threshold AS heart_rate_alert,
           total_distance_ft >= distance_alert_threshold AS distance_alert
    FROM (SELECT e.*, CAST(coalesce(t.hr_alert_threshold, 209.0) AS DOUBLE) AS hr_alert_threshold,
                 CAST(coalesce(t.distance_alert_threshold, 14520.0) AS DOUBLE) AS distance_alert_threshold
          FROM texe e LEFT JOIN thr t USING (player_id)) AS j_) AS f_)"""

EXE_D = ["avg_heart_rate", "max_heart_rate", "total_distance_ft", "avg_speed_mph"]
ALERT_D = EXE_D + ["hr_alert_threshold", "distance_alert_threshold"]
TEL_D = ["event_time", "x_court_ft", "y_court_ft", "speed_mph", "acceleration", "cumulative_distance",
         "heart_rate_bpm"]

q("telemetry_encode", """
SELECT CAST(player_id AS VARCHAR) AS key, CAST(game_id AS VARCHAR) AS game_id, CAST(player_id AS VARCHAR) AS player_id,
       CAST(team_id AS VARCHAR) AS team_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS game_timestamp,
       epoch_us("timestamp") / 1e6 AS event_time, x_court_ft, y_court_ft, speed_mph, acceleration,
       distance_covered_ft AS cumulative_distance, heart_rate_bpm
FROM tracking WHERE "timestamp" IS NOT NULL
""", TEL_D)
ORACLE["telemetry_written"] = ORACLE["telemetry_encode"]
q("telemetry_source", "SELECT event_id, user_id, event_type, value FROM events", ["value"])
q("telemetry_decode", "SELECT * FROM tdec", TEL_D, extra=TELE)
q("windowed_exertion", "SELECT * FROM texe", EXE_D, extra=TELE)
q("stream_windowed_exertion", "SELECT * FROM texe", EXE_D, extra=TELE)
WIDE = f""",
twide AS (
  SELECT make_timestamp(w_ * 604800000000) AS window_start, make_timestamp((w_ + 1) * 604800000000) AS window_end,
         player_id, {hu('avg(heart_rate_bpm)', 1)} AS avg_heart_rate,
         {hu('max(heart_rate_bpm)', 1)} AS max_heart_rate, {hu('sum(cumulative_distance)', 1)} AS total_distance_ft,
         {hu('avg(speed_mph)', 2)} AS avg_speed_mph, count(*) AS tracking_frames
  FROM (SELECT *, CAST(floor(floor(event_time) / 604800) AS BIGINT) AS w_ FROM tdec) AS d_
  GROUP BY w_, player_id)"""
for _name in ("windowed_exertion_wide", "stream_windowed_exertion_wide"):
    q(_name, "SELECT * FROM twide", EXE_D, extra=TELE + WIDE)
q("alerts_wide", """
SELECT *, heart_rate_alert OR distance_alert AS fatigue_alert FROM (
  SELECT *, avg_heart_rate >= hr_alert_threshold AS heart_rate_alert,
         total_distance_ft >= distance_alert_threshold AS distance_alert
  FROM (SELECT e.*, CAST(coalesce(t.hr_alert_threshold, 209.0) AS DOUBLE) AS hr_alert_threshold,
               CAST(coalesce(t.distance_alert_threshold, 14520.0) AS DOUBLE) AS distance_alert_threshold
        FROM twide e LEFT JOIN thr t USING (player_id)) AS j_) AS f_
""", ALERT_D, extra=TELE + WIDE)
q("stream_alerts", "SELECT * FROM talerts", ALERT_D, extra=TELE)
q("stream_live_exertion", "SELECT * FROM talerts", ALERT_D, extra=TELE)
q("stream_live_exertion_update", "SELECT * FROM talerts", ALERT_D, extra=TELE)
q("stream_alert_sink", """
SELECT * FROM talerts
WHERE fatigue_alert AND window_end <= (SELECT max(event_timestamp) FROM tdec) - INTERVAL 10 SECOND
""", ALERT_D, extra=TELE)
q("live_exertion_ranking", f"""
SELECT player_id, team_id, game_id, window_start, window_end, avg_heart_rate, max_heart_rate, hr_alert_threshold,
       {hu('total_distance_ft / 5280', 2)} AS distance_miles, {hu('distance_alert_threshold / 5280', 2)} AS threshold_miles,
       tracking_frames, heart_rate_alert, distance_alert, fatigue_alert
FROM talerts
""", ["avg_heart_rate", "max_heart_rate", "hr_alert_threshold", "distance_miles", "threshold_miles"], extra=TELE)
q("heart_rate_alerts", """
SELECT player_id, team_id, game_id, avg_heart_rate, hr_alert_threshold, heart_rate_alert
FROM talerts WHERE heart_rate_alert
""", ["avg_heart_rate", "hr_alert_threshold"], extra=TELE)
q("distance_alerts", f"""
SELECT player_id, team_id, game_id, {hu('total_distance_ft / 5280', 2)} AS distance_miles,
       {hu('distance_alert_threshold / 5280', 2)} AS threshold_miles, distance_alert
FROM talerts WHERE distance_alert
""", ["distance_miles", "threshold_miles"], extra=TELE)
q("substitution_candidates", f"""
SELECT player_id, team_id, game_id, avg_heart_rate, hr_alert_threshold,
       {hu('total_distance_ft / 5280', 2)} AS distance_miles, {hu('distance_alert_threshold / 5280', 2)} AS threshold_miles,
       heart_rate_alert, distance_alert
FROM talerts WHERE fatigue_alert
""", ["avg_heart_rate", "hr_alert_threshold", "distance_miles", "threshold_miles"], extra=TELE)
for _name in ("team_alert_summary", "team_summary_rollup", "stream_team_summary"):
    q(_name, f"""
SELECT team_id, count(DISTINCT player_id) AS players_monitored,
       CAST(sum(CASE WHEN fatigue_alert = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS total_alerts,
       CAST(sum(CASE WHEN heart_rate_alert = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS hr_alerts,
       CAST(sum(CASE WHEN distance_alert = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS distance_alerts,
       {hu('avg(avg_heart_rate)', 1)} AS team_avg_hr
FROM talerts GROUP BY team_id
""", ["team_avg_hr"], extra=TELE)
q("top_alerts", """
SELECT * FROM talerts WHERE fatigue_alert
ORDER BY avg_heart_rate DESC, player_id, window_start, game_id, team_id LIMIT 5
""", ALERT_D, extra=TELE)
for _name in ("stream_freshness", "stream_output_freshness"):
    q(_name, """
SELECT team_id, max(window_end) AS latest_window_end, min(window_start) AS first_window_start, count(*) AS windows,
       count(*) FILTER (WHERE fatigue_alert) AS alert_windows,
       CAST((epoch_us(max(window_end)) - epoch_us(min(window_start))) / 60000000 - count(DISTINCT window_start) AS BIGINT)
         AS windows_missing
FROM talerts GROUP BY team_id
""", extra=TELE)

# ---- sources and sinks --------------------------------------------------------------------------
q("scan_csv", "SELECT * FROM tracking", TRACK_D)
q("scan_json", "SELECT * FROM stats", ["minutes_played", "plus_minus"])
q("publish_roundtrip", "SELECT * FROM btb", BTB_D, extra=BTB)
q("publish_partitioned", """
SELECT team_id, count(*) AS "rows", sum(rolling_5g_distance) AS rolling_distance FROM rolling GROUP BY team_id
""", ["rolling_distance"])
q("read_optional", "SELECT count(*) AS \"rows\" FROM events")
q("gate_alert_output", """
SELECT 'alert_output' AS "check", 'streaming_alerts' AS subject, count(*) AS "rows",
       CASE WHEN count(*) > 0 THEN 'present' ELSE 'warn: no alerts written' END AS status, TRUE AS passed
FROM talerts
WHERE fatigue_alert AND window_end <= (SELECT max(event_timestamp) FROM tdec) - INTERVAL 10 SECOND
""", extra=TELE)
q("published_census", """
SELECT 'processed' AS zone, 'tracking_with_stats' AS dataset, count(*) AS "rows"
  FROM (SELECT DISTINCT game_id, player_id, team_id FROM tws) AS a_
UNION ALL SELECT 'processed', 'tracking_stats_schedule', count(*)
  FROM (SELECT DISTINCT game_id, player_id, team_id, "date", back_to_back, travel_distance_miles,
               rest_days_since_last_game FROM tss) AS b_
UNION ALL SELECT 'processed', 'training_with_schedule', count(*) FROM tsched
UNION ALL SELECT 'processed', 'player_game_workload', count(*) FROM pgw
UNION ALL SELECT 'analytics', 'rolling_workload', count(*) FROM rolling
UNION ALL SELECT 'analytics', 'workload_tiers', count(DISTINCT t_) FROM (SELECT ntile(4) OVER () AS t_ FROM rolling) AS c_
UNION ALL SELECT 'analytics', 'back_to_back_analysis', count(*) FROM btb
UNION ALL SELECT 'analytics', 'btb_by_profile', count(*)
  FROM (SELECT DISTINCT p.workload_profile, b.back_to_back FROM btb b LEFT JOIN profile p USING (player_id)) AS d_
UNION ALL SELECT 'analytics', 'travel_rest_analysis', count(*)
  FROM (SELECT DISTINCT rest_days_since_last_game, back_to_back FROM tss) AS e_
UNION ALL SELECT 'analytics', 'travel_bucket_analysis', count(*)
  FROM (SELECT DISTINCT CASE WHEN travel_distance_miles < 500 THEN 1 WHEN travel_distance_miles < 1500 THEN 2 ELSE 3 END,
               rest_days_since_last_game FROM tss) AS f_
UNION ALL SELECT 'analytics', 'training_load_analysis', count(*) FROM tload
UNION ALL SELECT 'analytics', 'weekly_training', count(*) FROM weekly
UNION ALL SELECT 'analytics', 'intensity_performance', count(DISTINCT high_intensity_week) FROM wperf
UNION ALL SELECT 'analytics', 'ratio_performance', count(DISTINCT CASE WHEN practice_recovery_ratio <= 1 THEN 1
                                                  WHEN practice_recovery_ratio <= 2 THEN 2 ELSE 3 END) FROM wperf
UNION ALL SELECT 'analytics', 'injury_risk_features', count(*) FROM features
""", extra=BTB + "," + PROFILE + "," + TRAINING + "," + RISK)
COLUMNS = {
    "tracking_with_stats": 27, "tracking_stats_schedule": 31, "training_with_schedule": 15, "player_game_workload": 13,
    "rolling_workload": 16, "workload_tiers": 5, "back_to_back_analysis": 9, "btb_by_profile": 6, "travel_rest_analysis": 8,
    "travel_bucket_analysis": 6, "training_load_analysis": 7, "weekly_training": 10, "intensity_performance": 7,
    "ratio_performance": 5, "injury_risk_features": 13,
}
ORACLE["dataset_manifest"] = (
    f"SELECT c_.*, CAST(CASE dataset {' '.join(f"WHEN '{k}' THEN {v}" for k, v in COLUMNS.items())} END AS INTEGER) AS columns, "
    f"c_.\"rows\" >= 0 AS present FROM ({ORACLE['published_census']}) AS c_")
q("stream_progress", """
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS num_input_rows, '1970-01-01T00:00:00.000Z' AS watermark FROM events
UNION ALL
SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT),
       strftime(max(event_timestamp) - INTERVAL 10 SECOND, '%Y-%m-%dT%H:%M:%S.000Z') FROM tdec
""", extra=TELE)
q("gate_outputs", "\nUNION ALL\n".join(
    f"SELECT 'outputs_present' AS \"check\", '{name}' AS subject, "
    f"CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failures, count(*) > 0 AS passed FROM {src}"
    for name, src in [("tracking_with_stats", "tws"), ("training_with_schedule", "tsched"),
                      ("tracking_stats_schedule", "tss"), ("rolling_workload", "rolling"),
                      ("back_to_back_analysis", "btb"), ("travel_rest_analysis", "travel_rest"),
                      ("training_load_analysis", "tload")]),
  extra=BTB + "," + TRAINING + "," + TRAVEL_REST)
