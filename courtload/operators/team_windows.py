"""A20 from mergeable per-window summaries: exact distinct players without reading players' rows again.

A row of ``window_counts`` stands for one (group, window, part of the ids).  Its bitmap holds the players of that part,
one bit each, and its sums are plain sums, so rows of any windows, batches or partitions merge: bitmaps by OR, the rest by
addition.  Ids are told exactly: decimal numbers from 0 on are bits of a part of 32,768 ids; any other id is a part of its own.
A row's bitmap takes 4 KB, and a group of a window has at most as many rows as players.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtload.functions.exprs import sround

PART, OTHER, BITS = "id_part", "other_id", "players"
FLAGS = {"total_alerts": "fatigue_alert", "hr_alerts": "heart_rate_alert", "distance_alerts": "distance_alert"}
SUMS = (*FLAGS, "hr_sum", "hr_windows", "windows")


def _number(member: str) -> Column:
    """The id as a number from 0 on, NULL if it isn't written as one."""
    n = F.col(member).cast("string").try_cast("long")
    return F.when((n >= 0) & (n.cast("string") == F.col(member).cast("string")), n)


def player_bits(rows: DataFrame, by: Sequence[str | Column], *sums: Column, member: str = "player_id") -> DataFrame:
    """One row per ``by`` and part of the ids, with the part's bitmap.  Spark's streams can't count distinct values; they
    can keep this, and as bitmaps only gain bits, every version that update mode emits may be merged."""
    n = _number(member)
    marked = rows.withColumns({PART: F.bitmap_bucket_number(n), OTHER: F.when(n.isNull(), F.col(member).cast("string")),
                               "_bit": F.bitmap_bit_position(n)})
    return marked.groupBy(*by, PART, OTHER).agg(F.bitmap_construct_agg("_bit").alias(BITS), *sums)


def window_counts(alerts: DataFrame, by: Sequence[str] = ("team_id",), window: str = "window_start",
                  member: str = "player_id") -> DataFrame:
    """A20's mergeable form, per group and window."""
    flags = [F.count_if(F.col(c)).alias(name) for name, c in FLAGS.items()]
    return player_bits(alerts, [*by, window], *flags, F.sum("avg_heart_rate").alias("hr_sum"),
                       F.count("avg_heart_rate").alias("hr_windows"), F.count(F.lit(1)).alias("windows"), member=member)


def merge_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summaries of a coarser grain, e.g. ``[team, day]`` or ``[team]``; they merge on like the ones given."""
    present = [F.sum(c).alias(c) for c in SUMS if c in counts.columns]
    return counts.groupBy(*by, PART, OTHER).agg(F.bitmap_or_agg(BITS).alias(BITS), *present)


def _members() -> Column:
    """Distinct ids, over merged rows: a part's bits, or the one id that is no number."""
    return F.sum(F.when(F.col(OTHER).isNotNull(), 1).otherwise(F.bitmap_count(BITS))).cast("long")


def distinct_members(counts: DataFrame, by: Sequence[str], name: str = "players_monitored") -> DataFrame:
    """Exact distinct ids per ``by``."""
    return merge_counts(counts, by).groupBy(*by).agg(_members().alias(name))


def team_summary(counts: DataFrame, by: Sequence[str] = ("team_id",)) -> DataFrame:
    """A20 from summaries: what ``alerts.team_alert_summary`` gives over the rows that they sum up."""
    return merge_counts(counts, by).groupBy(*by).agg(
        _members().alias("players_monitored"),
        *(F.sum(name).alias(name) for name in FLAGS),
        sround(F.try_divide(F.sum("hr_sum"), F.sum("hr_windows")), 1).alias("team_avg_hr"))
