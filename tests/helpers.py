"""Comparison helpers shared by the tests (same normalisation as tools/oracle_check.py)."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT:
            return None
    except Exception:  # noqa: BLE001
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        if hasattr(v, "hour"):
            if (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
                return v.date().isoformat() if hasattr(v, "date") else v.isoformat()
            return v.isoformat(sep=" ")
        return v.isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def table(pdf):
    cols = sorted(pdf.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)
    return cols, rows


def rows(df, order=None):
    """Collect a small Spark DataFrame as a list of dicts."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
