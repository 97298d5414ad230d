"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from courtload.functions.exprs import (  # noqa: F401
    bucket, epoch_seconds, literal_rows, sround, in_range, out_of_range, pct, round_doubles, safe_div,
    utc_wallclock, week_start,
)
