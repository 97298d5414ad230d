"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextvars
import ctypes
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.session import materialize, run_intermediates, scratch_path

__all__ = ["by_row", "field_type", "materialize", "numbered", "outlasting", "returned", "scratch_path", "ship", "table"]

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    path = Path(tempfile.mkdtemp(prefix="courtload-py-"), "courtload_pkg.zip")   # read by the driver's file server
    path.write_bytes(buffer.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a Python pass; afterwards the worker, which later tasks use again, gives free memory back."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
        if trim:
            trim(0)


#: Row numbers are sent to every executor up to this count (8 bytes each), else joined by a shuffle.
BROADCAST_ROWS = 4_000_000


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A written copy of the rows with a number each, and the name of that column.

    Places in a scan (monotonically_increasing_id) depend on how it is split, which changes with the cores at hand; so rows
    that several passes must agree on are numbered once, and all passes read the copy.
    """
    row = "row"
    while row.lower() in (c.lower() for c in df.columns):
        row += "_"
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), name), row


def outlasting(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, written; the tables written on the way to it are removed."""
    outside = contextvars.copy_context()
    with run_intermediates(spark, f"{name}-steps"):
        return outside.run(materialize, build(), name)


def by_row(docs: DataFrame, row_col: str, rows: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``numbered`` wide rows with ``rows``, a written table of single numbers (``row``); the number goes."""
    rows = rows.select(F.col("row").alias(row_col))
    return docs.join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows.hint("merge"), row_col, how).drop(row_col)
