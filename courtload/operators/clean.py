"""Cleaning, profiling and keyed de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtload.functions.exprs import in_range, out_of_range


def keep_in_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Inclusive range filter; NULL values are dropped (predicate is NULL)."""
    return df.filter(in_range(col, lo, hi))


def out_of_range_counts(df: DataFrame, rules: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One pass, one row per rule: (column, lo, hi, out_of_range, checked)."""
    aggs = []
    for c, (lo, hi) in rules.items():
        aggs += [F.count_if(out_of_range(c, lo, hi)).alias(f"o__{c}"), F.count(c).alias(f"n__{c}")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                 F.col(f"o__{c}").alias("out_of_range"), F.col(f"n__{c}").alias("checked"))
        for c, (lo, hi) in rules.items()
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def parse_dates(df: DataFrame, cols: Iterable[str], fmt: str | None = None) -> DataFrame:
    """String -> DATE; malformed values become NULL instead of failing under ANSI."""
    out = df
    for c in cols:
        parsed = F.try_to_date(F.col(c), F.lit(fmt)) if fmt else F.try_to_date(F.col(c))
        out = out.withColumn(c, parsed)
    return out


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column NULL defaulting."""
    return df.fillna(dict(defaults))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with the NULL count of every column (single pass)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def describe_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed describe(): one row per column with count, mean, stddev, min, max (one pass)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n__{c}"), F.avg(x).alias(f"m__{c}"), F.stddev(x).alias(f"s__{c}"),
                 F.min(x).alias(f"lo__{c}"), F.max(x).alias(f"hi__{c}")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n__{c}").alias("count"), F.col(f"m__{c}").alias("mean"),
                 F.col(f"s__{c}").alias("stddev"), F.col(f"lo__{c}").alias("min"), F.col(f"hi__{c}").alias("max"))
        for c in cols
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def table_census(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) for every table; one aggregate per table, unioned."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def player_team_map(tracking: DataFrame, player: str = "player_id", team: str = "team_id") -> DataFrame:
    """Distinct (player, team) pairs (partial aggregation before the shuffle)."""
    return tracking.select(player, team).distinct()


def dedupe_keys(df: DataFrame, keys: Sequence[str], repeated: DataFrame | None = None) -> DataFrame:
    """One row per key; the kept row is the smallest by the remaining columns.

    Same shape as ``dropDuplicates(keys)`` but deterministic, and done as an
    aggregate (map-side partial min) so a hot key never lands whole in one task.
    ``repeated``: a small table of distinct keys that holds all with more than one row; rows of other keys then stay where they are.
    """
    if repeated is not None:
        again = repeated.select(*[F.col(k).alias(f"_r{n}") for n, k in enumerate(keys)])
        same = F.lit(True)
        for n, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"_r{n}"))
        several = dedupe_keys(df.join(F.broadcast(again), same, "left_semi"), keys)
        return df.join(F.broadcast(again), same, "left_anti").unionByName(several)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_keep"))
    return picked.select(*keys, *[F.col(f"_keep.{c}").alias(c) for c in rest]).select(*df.columns)
