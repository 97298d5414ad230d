"""Small expression builders shared by the operators.

All return ``Column`` objects built from ``pyspark.sql.functions`` so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (Spark 3 non-ANSI result, no error under ANSI)."""
    return F.try_divide(_c(num), _c(den))


SNAP_DIGITS = 9


def sround(col, digits: int) -> Column:
    """``round(col, digits)`` HALF_UP, applied to the value snapped to 1e-9.

    Means of low-precision data often sit exactly on a half (4.75); the last
    bits of a floating sum depend on the order partitions are combined in, so
    the raw value may be 4.7499999999 or 4.7500000001.  Snapping first makes
    the tie round the same way every run (and the same way as the oracle).
    """
    return F.round(F.round(_c(col), SNAP_DIGITS), digits)


def pct(made, attempts, digits: int = 2) -> Column:
    """round(made / attempts * 100, digits) with a zero denominator giving NULL."""
    return sround(safe_div(made, attempts) * F.lit(100), digits)


def in_range(col, lo: float, hi: float) -> Column:
    """Inclusive keep predicate; a NULL value yields NULL (row dropped by filter)."""
    c = _c(col)
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


def out_of_range(col, lo: float, hi: float) -> Column:
    c = _c(col)
    return (c < F.lit(lo)) | (c > F.lit(hi))


def bucket(col, edges: Sequence[float], labels: Sequence[str], inclusive: bool = False) -> Column:
    """CASE chain: first label whose upper edge is not reached; NULL falls to the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = _c(col)
    out = None
    for edge, label in zip(edges, labels):
        cond = (c <= F.lit(edge)) if inclusive else (c < F.lit(edge))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def week_start(col) -> Column:
    """Monday of the week of a date, as a DATE (date_trunc('week') cast back to date)."""
    return F.to_date(F.date_trunc("week", _c(col)))


def epoch_seconds(ts_ntz) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ (wall clock read as UTC), as double."""
    col = _c(ts_ntz)
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col).cast("double") / F.lit(1e6)


def utc_wallclock(ts_ltz) -> Column:
    """An instant (TIMESTAMP) as its UTC wall clock (TIMESTAMP_NTZ), independent of session zone."""
    return F.timestamp_add("SECOND", F.unix_seconds(_c(ts_ltz)), F.expr(EPOCH_NTZ))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for presentation (HALF_UP, like ``F.round``)."""
    cols = [
        sround(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def literal_rows(spark, rows: Sequence[Sequence], schema) -> DataFrame:
    """A small, bounded list of rows as a JVM-side literal table (``inline`` of a struct array).

    ``createDataFrame`` on a Python list plans a Python RDD and starts a
    Python worker; these rows (gate results, expected names, progress
    records) need none.  ``schema`` is a ``StructType`` or a DDL string.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
