"""Domain-neutral building blocks: grouped measures, value counts, top-k, one-pass
correlations.  The named operators are compositions of these."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtload.functions.exprs import sround


def _weighted(how: str, source: str, weight: str) -> Column:
    """A count or a mean over rows that each stand for ``weight`` equal ones."""
    x, w = F.col(source), F.when(F.col(source).isNotNull(), F.col(weight))
    if how == "count":
        return F.coalesce(F.sum(w), F.lit(0)).cast("long")
    if how == "avg":
        return F.try_divide(F.sum(w * x), F.sum(w))
    raise ValueError(f"no weighted {how}")


AGGREGATES = {"avg": F.avg, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "stddev": F.stddev}


def compare_by(df: DataFrame, by: Sequence[str], measures: Sequence[tuple[str, str, str, int | None]],
               *extra: Column, weights: Mapping[str, str] | None = None) -> DataFrame:
    """One row per value of ``by`` (one in all if empty) with its measures.

    A measure is (output column, aggregate, input column, digits to round to or None).
    ``weights``: columns that say for how many equal rows one stands, by input column ("" for those not named); counts and means then.
    """
    def of(how: str, source: str) -> Column:
        return AGGREGATES[how](source) if weights is None else _weighted(how, source, weights.get(source, weights[""]))
    made = [of(how, source) if digits is None else sround(of(how, source), digits) for _, how, source, digits in measures]
    return df.groupBy(*by).agg(*(c.alias(m[0]) for c, m in zip(made, measures)), *extra)


def value_counts(col: str, values: Sequence, name: str = "{}_count") -> list[Column]:
    """A count of each of some values of a column, as aggregates."""
    return [F.count_if(F.col(col) == v).alias(name.format(v)) for v in values]


def top_k(df: DataFrame, by: Sequence[Column], k: int, tie: Sequence[str] = ()) -> DataFrame:
    """First k rows in ``by`` order with a deterministic tie-break (TakeOrderedAndProject)."""
    return df.orderBy(*by, *[F.col(c).asc_nulls_last() for c in tie]).limit(k)


def correlations(df: DataFrame, pairs: Mapping[str, tuple[str, str]], long: bool = False,
                 name_col: str = "feature", value_col: str = "correlation") -> DataFrame:
    """Pearson correlation for every (x, y) pair in one aggregate; undefined -> NULL.

    ``long=True`` returns one row per pair instead of one wide row.
    """
    wide = df.agg(*[F.nanvl(F.corr(x, y), F.lit(None)).alias(n) for n, (x, y) in pairs.items()])
    if not long:
        return wide
    rows = [F.struct(F.lit(n).alias(name_col), F.col(n).alias(value_col)) for n in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
