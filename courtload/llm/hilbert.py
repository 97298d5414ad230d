"""Shards as runs of a Hilbert curve over several metadata dimensions; DataFrame functions only.

Each dimension is quantised into equally filled steps (approximate percentiles of numbers; of texts,
the number that their first bytes after the common prefix make), so each step keeps the column's order
and each shard covers short ranges of every dimension: file statistics then prune by any of them.
The steps of a row give its place on the curve (Skilling's transform, folded over one array).  Rows are
sorted by that place and cut into runs.

Two laws: ``rows`` cuts runs whose row counts are at most one apart, ``bytes`` cuts where the sizes
before a row pass a multiple of the mean.  Ranks come from one range shuffle of narrow rows (never the
texts): the index within a sorted partition plus the rows (or bytes) of the partitions before it.  Of
equal places, rows are ordered by the text's crc32 and size, then by id, then as read, so equal texts lie together
and a place that a third of all rows share is split by the range shuffle like any other.

Defined cases: null metadata sorts first; null text has no bytes and crc32 0; repeated rows and null ids
are rows like any other; an empty table gives an empty result; other columns are not read.  Fewer rows
than shards leave shards empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from courtload.llm.common import field_type, materialize

SHARDS = 40
BITS = 6
#: Size of a row besides its text.
ROW_BYTES = 16
#: Bytes of a text that give its number.
_PREFIX = 7
_WITHIN = (1 << 33) - 1


def text_number(column: Column, skip: int) -> Column:
    """The first bytes after ``skip`` as a number, in the order of the texts."""
    head = F.hex(F.substring(column.cast("binary"), skip + 1, _PREFIX))
    return F.conv(F.rpad(head, 2 * _PREFIX, "0"), 16, 10).cast("long")


def _numbers(df: DataFrame, dims: list[str]) -> dict[str, Column]:
    """A number for each dimension, in the column's order."""
    texts = [d for d in dims if isinstance(field_type(df, d), T.StringType)]
    ends = df.agg(*(f(d).alias(f"{n}_{i}") for i, d in enumerate(texts) for n, f in (("low", F.min), ("high", F.max)))
                  ).first() if texts else None
    out = {d: F.col(d).cast("double") for d in dims}
    for i, d in enumerate(texts):
        low, high = ((ends[f"{n}_{i}"] or "").encode() for n in ("low", "high"))
        skip = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        out[d] = text_number(F.col(d), skip).cast("double")
    return out


def steps(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """The step (0 to 2**bits - 1) of each dimension; two small aggregations over the table."""
    numbers = _numbers(df, dims)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    limits = df.agg(*(F.percentile_approx(n, shares, 10_000).alias(f"c{i}") for i, n in enumerate(numbers.values()))).first()
    out = []
    for i, n in enumerate(numbers.values()):
        bounds = sorted(set(limits[f"c{i}"] or []))
        at = F.lit(0)
        if bounds:   # as many steps as limits below the value, spread over the whole range where a dimension has few values
            at = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < n)), F.lit(0))
            at = F.floor(at * F.lit((1 << bits) - 1) / F.lit(len(bounds)))
            at = F.when(n.isNull(), 0).otherwise(at)
        out.append(at.cast("int"))
    return out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def curve_index(axes: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point, after J. Skilling, "Programming the Hilbert curve" (2004)."""
    d = len(axes)
    powers = F.array(*(F.lit(1 << b) for b in range(bits)))

    def over(bits_down: range, fold: Callable[[Column, Column, Column], Column], start: Column) -> Column:
        """Fold over bits from the highest, and over the axes of each."""
        walk = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in bits_down for i in range(d)))
        return F.aggregate(walk, start, lambda acc, s: fold(acc, s["q"], s["i"]))

    def turn(x: Column, q: Column, i: Column) -> Column:
        """Where axis i has bit q, invert the lower bits of the first axis; else swap those bits between both."""
        low, set_ = q - 1, F.get(x, i).bitwiseAND(q) != 0
        swap = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, i)).bitwiseAND(low)
        return F.transform(x, lambda v, k: F.when(set_ & (k == 0), v.bitwiseXOR(low))
                           .when(~set_ & ((k == 0) | (k == i)), v.bitwiseXOR(swap)).otherwise(v))

    def gray(x: Column) -> Column:
        return F.transform(x, lambda _, k: F.aggregate(F.slice(x, F.lit(1), k + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def flips(x: Column) -> Column:
        return F.aggregate(F.slice(powers, 2, bits - 1), F.lit(0), lambda t, q: F.when(
            F.get(x, F.lit(d - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))

    def interleaved(x: Column, t: Column) -> Column:
        return over(range(bits - 1, -1, -1), lambda h, q, i: h * 2 + F.when(
            F.get(x, i).bitwiseXOR(t).bitwiseAND(q) != 0, 1).otherwise(0), F.lit(0).cast("long"))

    turned = over(range(bits - 1, 0, -1), turn, F.array(*axes))
    return bound(turned, lambda x: bound(gray(x), lambda g: bound(flips(g), lambda t: interleaved(g, t))))


def shards(docs: DataFrame, dims: list[str], id_col: str = "doc_id", text_col: str = "text", count: int = SHARDS,
           law: str = "rows", bits: int = BITS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law: rows or bytes, not {law}")
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    placed = docs.select(F.col(id_col), (F.octet_length(data).cast("long") + ROW_BYTES).alias("size"),
                         F.crc32(data).alias("text_crc32"), curve_index(steps(docs, dims, bits), bits).alias("place"),
                         F.monotonically_increasing_id().alias("seen"))
    by = ["place", "text_crc32", "size", id_col, "seen"]
    # written once, as the partitions' numbers and contents come from sampled bounds
    ranked = materialize(placed.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("at", F.monotonically_increasing_id()), "curve").withColumn("part", F.shiftright("at", 33))
    parts = ranked.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    before, every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    parts = parts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "nb"),
                         *(F.sum(c).over(every).alias(c) for c in "nb"))
    rows = ranked.join(F.broadcast(parts), "part").withColumn(   # a row per partition
        "rank", F.col("n0") + F.col("at").bitwiseAND(F.lit(_WITHIN)))
    if law == "rows":
        out = rows.withColumn("shard", F.expr(f"rank * {count} div n")).withColumn(
            "slot", F.expr(f"rank - (shard * n + {count - 1}) div {count}"))
    else:
        inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        cut = rows.withColumn("shard", F.floor(
            (F.col("b0") + F.coalesce(F.sum("size").over(inside), F.lit(0))) * count / F.col("b")))
        firsts = cut.groupBy("shard").agg(F.min("rank").alias("first"))   # a row per shard
        out = cut.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("first"))
    return out.select(id_col, "size", "text_crc32", F.lit(law).alias("law"), F.col("shard").cast("int").alias("shard"),
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
