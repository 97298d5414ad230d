"""Derive the five domain tables and the telemetry feed from the driver tables.

These are plain projections/joins over the parquet tables, so column
pruning and filter pushdown reach the scans.  The rules are the ones in
FIXTURES.md; the DuckDB oracle repeats them as CTEs (plans/oracle.py).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtload.functions.exprs import epoch_seconds

DATE_SHIFT_DAYS = 8766          # moves 2024 event days into the 1995-2001 schedule range
MALFORMED_EVERY = 97            # every 97th event id carries an unparseable date string
SESSION_OF_EVENT = (("click", "practice"), ("view", "gym"), ("purchase", "recovery"), ("signup", "film"))


#: The tables the five domain tables and the feed are derived from.
INPUTS = ("lineitem", "supplier", "orders", "customer", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def player_tracking(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice",
                         "l_discount", "l_tax", "l_shipdate")
    su = supplier.select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey, "inner")
    return j.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_nationkey").alias("team_id"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_discount") * 940).alias("x_court_ft"),
        (F.col("l_tax") * 625).alias("y_court_ft"),
        (F.col("l_quantity") / 2).alias("speed_mph"),
        ((F.col("l_discount") - F.col("l_tax")) * 100).alias("acceleration"),
        (F.col("l_quantity") * 10).alias("distance_covered_ft"),
        (F.lit(40) + F.lit(200) * (F.col("l_extendedprice") - 1) / 110000).alias("heart_rate_bpm"),
    )


def game_stats(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        (F.col("l_quantity") / 5).alias("minutes_played"),
        F.col("l_linenumber").alias("points"),
        (F.col("l_tax") * 100 - 4).alias("plus_minus"),
        F.col("l_quantity").cast("int").alias("shot_attempts"),
        F.floor(F.col("l_quantity") * (F.lit(0.4) + F.col("l_discount"))).cast("int").alias("shot_made"),
    )


def team_schedules(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("c_nationkey").alias("home_team"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int").alias("away_team"),
        (F.col("o_orderpriority") == "1-URGENT").alias("back_to_back"),
        (F.col("o_totalprice") / 200).alias("travel_distance_miles"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("rest_days_since_last_game"),
    )


def _shifted_date_string() -> F.Column:
    good = F.date_format(F.date_sub(F.to_date("ts"), DATE_SHIFT_DAYS), "yyyy-MM-dd")
    return F.when(F.col("event_id") % MALFORMED_EVERY == 0, F.lit("not-a-date")).otherwise(good)


def training_sessions(events: DataFrame) -> DataFrame:
    kind = None
    for ev, sess in SESSION_OF_EVENT:
        cond = F.col("event_type") == ev
        kind = F.when(cond, sess) if kind is None else kind.when(cond, sess)
    ev = events.select("event_id", "ts", "user_id", "event_type", "value").filter(F.col("event_type") != "error")
    return ev.select(
        F.col("user_id").alias("player_id"),
        _shifted_date_string().alias("date"),
        kind.alias("session_type"),
        (F.col("value") / 10).alias("intensity_score"),
        (F.lit(5) + (F.col("event_id") % 41) / 10).alias("sleep_hours_prev_night"),
        (F.lit(30) + F.col("event_id") % 91).cast("double").alias("duration_min"),
        (F.lit(55) + F.col("value") / 4).alias("heart_rate_avg"),
        (F.lit(55) + F.col("value") / 4 + F.col("event_id") % 60).alias("heart_rate_max"),
    )


def injury_reports(events: DataFrame) -> DataFrame:
    ev = events.select("event_id", "ts", "user_id", "event_type", "value").filter(F.col("event_type") == "error")
    eid, v = F.col("event_id"), F.col("value")
    return ev.select(
        F.col("user_id").alias("player_id"),
        _shifted_date_string().alias("date"),
        F.when(eid % 7 == 0, F.lit(None).cast("int")).otherwise(F.floor(v / 20).cast("int")).alias("games_missed"),
        F.when(eid % 3 == 0, F.lit(None).cast("string"))
         .when(v >= 200, "surgery").when(v >= 50, "physio").otherwise("rest").alias("treatment"),
        F.when(eid % 5 == 0, F.lit(None).cast("string"))
         .when(v >= 300, "severe").when(v >= 100, "moderate").otherwise("minor").alias("severity"),
    )


def telemetry_events(events: DataFrame) -> DataFrame:
    """One telemetry message per event, in the stream's field layout (works on a stream too)."""
    ev = events.select("event_id", "ts", "user_id", "value", "props")
    return ev.select(
        F.get_json_object("props", "$.k").alias("game_id"),
        F.col("user_id").cast("string").alias("player_id"),
        (F.col("user_id") % 25).cast("string").alias("team_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("game_timestamp"),
        epoch_seconds("ts").alias("event_time"),
        (F.col("event_id") % 95).cast("double").alias("x_court_ft"),
        (F.col("event_id") % 51).cast("double").alias("y_court_ft"),
        (F.col("value") / 20).alias("speed_mph"),
        (F.col("value") / 100 - 2).alias("acceleration"),
        (F.col("value") * 10).alias("cumulative_distance"),
        F.col("value").alias("heart_rate_bpm"),
    )


Table = DataFrame | Callable[[], DataFrame]


@dataclass
class Domain:
    """The raw domain tables of one data set (lazy DataFrames).

    A table may be given as a function that opens it: opening reads file footers, a job for each table, so
    that is left until the table is first used.
    """

    tracking: Table
    stats: Table
    schedule: Table
    training: Table
    incidents: Table
    events: Table | None = None

    def __getattribute__(self, name: str):
        value = super().__getattribute__(name)
        if name in Domain.__dataclass_fields__ and callable(value):
            value = value()
            setattr(self, name, value)
        return value

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "player_tracking": self.tracking, "game_stats": self.stats,
            "injury_reports": self.incidents, "training_sessions": self.training,
            "team_schedules": self.schedule,
        }


def load_domain(spark: SparkSession, sf_dir: str) -> Domain:
    table = cache(lambda name: read_table(spark, sf_dir, name))
    return Domain(
        tracking=lambda: player_tracking(table("lineitem"), table("supplier")),
        stats=lambda: game_stats(table("lineitem")),
        schedule=lambda: team_schedules(table("orders"), table("customer")),
        training=lambda: training_sessions(table("events")),
        incidents=lambda: injury_reports(table("events")),
        events=lambda: table("events"),
    )


RAW_FORMATS = {
    "player_tracking": "csv", "game_stats": "json", "injury_reports": "csv",
    "training_sessions": "json", "team_schedules": "csv",
}


def load_raw_domain(spark: SparkSession, paths: dict[str, str], land_to: str | None = None) -> Domain:
    """The five domain tables from raw files (CSV with header / JSON lines, gzip or not).

    Schemas are declared (``schemas.DOMAIN``), not inferred.  With ``land_to``
    each input is first landed as Parquet under that folder.
    """
    from courtload import schemas
    from courtload.sources.files import land_as_parquet, read_csv, read_json

    def load(name: str) -> DataFrame:
        fmt, schema = RAW_FORMATS[name], schemas.DOMAIN[name]
        if land_to:
            return land_as_parquet(spark, paths[name], schema, fmt, f"{land_to.rstrip('/')}/{name}.parquet")
        return read_csv(spark, paths[name], schema) if fmt == "csv" else read_json(spark, paths[name], schema)

    return Domain(tracking=load("player_tracking"), stats=load("game_stats"),
                  schedule=load("team_schedules"), training=load("training_sessions"),
                  incidents=load("injury_reports"))
