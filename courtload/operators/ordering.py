"""Rolling row frames and whole-table ntile without a one-task window, a global sort or a written copy.

``Window.partitionBy(player)`` puts a player with a third of the rows into one task, and
``Window.orderBy(...)`` the whole table.

* ``rolling_rows`` cuts the rows of each player with more than a chunk's into chunks.  A splitter table has, for each
  such player and each value of a coarse, order-preserving key (``split_on``), how many rows come before it; counts are
  exact, so that every evaluation cuts alike.  The rows before a chunk that its frames reach are sent to it too (the halo).
* ``ntile_rows`` finds the first row of each tile by selection: rounds of sketched percentiles and exact counts
  close in on it, and the rows then take one CASE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from courtload.operators.joins import dealt, ranged

#: Rows within a place's bracket that are fetched sorted instead of being closed in on.
FETCHED = 10_000
#: Sketch size of a round: a bracket keeps about four parts of so many of the rows before it.
ACCURACY = 1_000

_FRAME = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def splitters(df: DataFrame, part: str, split_on: Sequence[Column], n: int, chunk_rows: int) -> DataFrame:
    """(part, _s0.., _to): chunks that the rows of each (part, coarse key) go to, their own first.

    A chunk starts at the first coarse key at or after each multiple of ``chunk_rows``.  A key's rows are also
    sent to each later chunk that starts less than ``n - 1`` rows after them.
    """
    names = [f"_s{k}" for k in range(len(split_on))]
    counts = df.groupBy(F.col(part), *[c.alias(name) for c, name in zip(split_on, names)]).agg(F.count("*").alias("_n"))
    by_key = Window.partitionBy(part).orderBy(*[F.col(name).asc_nulls_first() for name in names])
    before = F.coalesce(F.sum("_n").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("_before", before).withColumn("_chunk", F.floor(F.col("_before") / chunk_rows))
    by_row = Window.partitionBy(part).orderBy("_before")
    starts = F.coalesce(F.col("_chunk") != F.lag("_chunk").over(by_row), F.lit(True))
    near = F.collect_list(F.when(F.col("_starts"), F.col("_chunk"))).over(by_row.rangeBetween(0, max(n - 2, 0)))
    placed = placed.withColumn("_starts", starts).withColumn("_near", near)
    later = F.coalesce(F.lead("_near").over(by_row), F.array().cast("array<bigint>")) if n > 1 else F.array().cast("array<bigint>")
    return placed.select(part, *names, F.concat(F.array("_chunk"), F.filter(later, lambda c: c > F.col("_chunk"))).alias("_to"))


def rolling_rows(df: DataFrame, part: str, order: Sequence[str], n: int, aggs: Mapping[str, tuple[str, str]],
                 method: str = "split", split_on: Sequence[Column] | None = None, chunk_rows: int = 1 << 20,
                 rows: int = 0, near: str | None = None) -> DataFrame:
    """Frame ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW`` per ``part``, by ``order`` ascending, nulls first.

    ``aggs`` maps output name -> (function, column) with function in {"sum", "avg", "min", "max", "count"}.
    ``order`` must make rows unique within ``part``.

    method="window": Spark's window operator (one task per ``part`` value).
    method="split": the window runs per ``part`` where it has at most ``chunk_rows`` rows, and per (part, chunk) where it has
    more; those are at most the rows / ``chunk_rows`` parts and are broadcast.  ``split_on`` is the coarse key, columns that never fall
    along ``order`` (by default its first column); a chunk has at most ``chunk_rows`` rows, those of one more coarse key
    and the halo.  Building the result starts no job and nothing is written; the input, which must come out alike each
    time, is read for the sizes of the parts, for the small parts and, if there are any, twice for the large ones.
    ``rows``: how many there are, if known (see ``joins.dealt``).
    ``near``: a column with one value in each ``part``; the rows are dealt by ranges of it, and come out in them.
    """
    if method not in ("window", "split"):
        raise ValueError(f"unknown method {method!r}")
    by = [F.col(c).asc_nulls_first() for c in order]

    def framed(made: DataFrame, *parts: str) -> DataFrame:   # dealt: merged partitions would sort millions of rows in a task
        parts = (near, *parts) if near else parts
        w = Window.partitionBy(*parts).orderBy(*by).rowsBetween(-(n - 1), 0)
        there = ranged(made, *parts, rows=rows) if near else dealt(made, *parts, rows=rows)
        return there.select("*", *[_FRAME[fn](c).over(w).alias(name) for name, (fn, c) in aggs.items()])
    if method == "window":
        return framed(df, part)
    sizes = df.groupBy(F.col(part).alias("_large")).agg(F.count("*").alias("_n"))
    large = F.broadcast(sizes.where(F.col("_n") > chunk_rows).select("_large"))
    is_large = F.col(part).eqNullSafe(F.col("_large"))
    small = df.join(large, is_large, "left_anti").select("*", F.lit(0).alias("_halo"), F.lit(0).cast("long").alias("_chunk"))
    cut = df.join(large, is_large, "left_semi")
    coarse = list(split_on or [F.col(order[0])])
    table = splitters(cut, part, coarse, n, chunk_rows).withColumnRenamed(part, "_part")
    keyed = cut.select("*", *[c.alias(f"_k{k}") for k, c in enumerate(coarse)])
    same = F.col(part).eqNullSafe(F.col("_part"))
    for k in range(len(coarse)):
        same &= F.col(f"_k{k}").eqNullSafe(F.col(f"_s{k}"))
    # a row once for its own chunk (place 0), and once for each chunk whose halo it is in
    copies = keyed.join(table, same).select(*df.columns, F.posexplode("_to").alias("_halo", "_chunk"))
    return framed(small.unionByName(copies), part, "_chunk").where("_halo = 0").drop("_halo", "_chunk")


def _number(df: DataFrame, col: str) -> Column:
    """The column as a number in the same order."""
    kind = df.schema[col].dataType
    if isinstance(kind, NumericType):
        return F.col(col)
    if kind.typeName() == "date":
        return F.unix_date(col)
    if kind.typeName() == "timestamp":
        return F.unix_micros(col)
    if kind.typeName() == "boolean":
        return F.col(col).cast("int")
    raise TypeError(f"{col}: selection needs a number, a date, a timestamp or a boolean, not {kind.simpleString()}")


class _Search:
    """Closing in on the row at one place of the order, column by column."""

    def __init__(self, rank: int) -> None:
        self.rank = rank                       # among the rows that share ``fixed``
        self.fixed: list[Any] = []             # values of the leading columns
        self.low = self.high = None            # open interval of the next column's number
        self.points: list = []
        self.rows = None                       # rows within the interval; None: not known yet
        self.below = 0                         # rows that share ``fixed`` and are at or under ``low``
        self.done: tuple | None = None


def rows_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> list[tuple]:
    """The values of ``order`` (ascending, nulls first) of the rows at some 0-based places, by distributed selection.

    A round is two aggregates over the rows for all places together: sketched percentiles within each place's bracket, then exact
    counts at these points, which leave about 4 / ACCURACY of the rows; FETCHED or fewer are sorted and fetched up to the
    place.  Where a value is the place's, the next column goes on among its ties.  Nothing else leaves the executors than a few
    numbers a place.  ``df`` must come out alike each time it is read: read it from storage.
    """
    searches = [_Search(r) for r in ranks]

    def inside(s: _Search) -> Column:
        c = F.lit(True)
        for name, v in zip(order, s.fixed):
            c &= F.col(name).eqNullSafe(F.lit(v))
        return c

    while live := [s for s in searches if s.done is None]:
        asked: list[Column] = []
        for k, s in enumerate(live):
            x, here = _number(df, order[len(s.fixed)]), inside(s)
            if s.rows is None:
                asked += [F.count_if(here).alias(f"n{k}"), F.count_if(here & x.isNull()).alias(f"null{k}"),
                          F.lit(None).cast("array<double>").alias(f"p{k}")]
                continue
            here = _between(here, x, s)
            at, slack = (s.rank - s.below + 0.5) / s.rows, 2 / ACCURACY
            wanted = sorted({min(max(p, 0.0), 1.0) for p in (at - slack, at, at + slack)})
            asked += [F.lit(None).alias(f"n{k}"), F.lit(None).alias(f"null{k}"),
                      F.percentile_approx(F.when(here, x), F.array(*map(F.lit, wanted)), ACCURACY).alias(f"p{k}")]
        seen = df.agg(*asked).first()
        counting = []
        for k, s in enumerate(live):
            if s.rows is None:      # the column's nulls, then the rest
                if s.rank < seen[f"null{k}"]:
                    _settle(df, order, s, None, seen[f"null{k}"], inside)
                else:
                    s.below, s.rows = seen[f"null{k}"], seen[f"n{k}"] - seen[f"null{k}"]
                continue
            s.points = sorted(set(seen[f"p{k}"]))
            counting.append(s)
        if not counting:
            continue
        parts = []
        for k, s in enumerate(counting):
            x, here = _number(df, order[len(s.fixed)]), inside(s)
            for j, p in enumerate(s.points):
                parts += [F.count_if(here & (x < F.lit(p))).alias(f"l{k}_{j}"), F.count_if(here & (x == F.lit(p))).alias(f"e{k}_{j}")]
            parts.append(F.count_if(here & x.isNull()).alias(f"null{k}"))
        seen = df.agg(*parts).first()
        for k, s in enumerate(counting):
            end = s.below + s.rows
            for j, p in enumerate(s.points):
                less = seen[f"l{k}_{j}"] + seen[f"null{k}"]
                equal = seen[f"e{k}_{j}"]
                if less <= s.rank < less + equal:
                    s.rank -= less
                    _settle(df, order, s, p, equal, inside)
                    break
                if less + equal <= s.rank:
                    s.low, s.below = p, less + equal
                else:
                    s.high, end = p, less
                    break
            if s.rows is not None and s.done is None:
                s.rows = end - s.below
                if s.rows <= FETCHED:
                    _fetch(df, order, s, _between(inside(s), _number(df, order[len(s.fixed)]), s), s.rank - s.below)
    return [s.done for s in searches]   # type: ignore[misc]


def _between(here: Column, x: Column, s: _Search) -> Column:
    """``here`` within the bracket of the next column."""
    if s.low is not None:
        here &= x > F.lit(s.low)
    if s.high is not None:
        here &= x < F.lit(s.high)
    return here


def _fetch(df: DataFrame, order: Sequence[str], s: _Search, where: Column, rank: int) -> None:
    """The row at ``rank`` of the few rows where a condition holds."""
    rest = order[len(s.fixed):]
    s.done = tuple(df.where(where).select(*order).orderBy(*[F.col(c).asc_nulls_first() for c in rest]).limit(rank + 1).collect()[-1])


def _settle(df: DataFrame, order: Sequence[str], s: _Search, number: Any, ties: int, inside) -> None:
    """The next column's value is known: its row is fetched if its ties are few, else the column after it is next."""
    name = order[len(s.fixed)]
    x = _number(df, name)
    same = inside(s) & (x.isNull() if number is None else x == F.lit(number))
    rest = list(order[len(s.fixed) + 1:])
    if ties <= FETCHED or not rest:
        return _fetch(df, order, s, same, s.rank)
    value = None if number is None else df.where(same).select(name).first()[0]
    s.fixed = [*s.fixed, value]
    s.low = s.high = s.rows = None
    s.below = 0


def ntile_rows(df: DataFrame, n: int, order: Sequence[str], out: str = "tile") -> DataFrame:
    """``ntile(n) OVER (ORDER BY order)`` for the whole table; ``order`` ascending, nulls first.

    Tile sizes follow SQL NTILE: the first ``N mod n`` tiles get one extra row.  The rows that tiles start with are
    selected (``rows_at``) when this is called; ``df`` must be read from storage.  The rows take one CASE.
    """
    total = df.count()
    base, extra = divmod(total, n)
    starts = [k * base + min(k, extra) for k in range(1, n)]
    starts = [s for k, s in enumerate(starts) if s < total and s > (starts[k - 1] if k else 0)]
    cuts = rows_at(df, order, starts) if starts else []
    key = F.struct(*[F.col(c).alias(f"k{k}") for k, c in enumerate(order)])
    tile = None
    for k in range(len(cuts), 0, -1):
        at = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(f"k{j}") for j, (v, c) in enumerate(zip(cuts[k - 1], order))])
        tile = F.when(key >= at, k + 1) if tile is None else tile.when(key >= at, k + 1)
    return df.withColumn(out, F.lit(1) if tile is None else tile.otherwise(1))
