"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into two halves; a codebook for each half, fitted on a bounded sample, makes a product
grid of cells, for each label and dimension.  Each vector lives in the cell of its nearest centroids and
visits others: by multi-sequence traversal, cells in the order of its distance to them (to the planes
between its centroid and theirs, both halves together) until the target recall is covered.  A linked
vector lies ``r = sqrt(2 - 2 cosine)`` away at most, so going that far never misses one.  How far is enough depends on the
directions in which linked vectors differ: it is measured on the linked pairs within the sample, for the target
recall and with a margin; without enough of them the traversal goes the whole way.  Only cells below its own in number are visited, so a pair meets once.

Within a cell, vectors are compared in blocks by exact cosine in double precision; a crowded cell is cut
into blocks of ``BLOCK`` vectors and each pair of blocks is a group of its own, so no group is larger
than two blocks.  Groups return the number of links by vector and a spanning forest of their links,
never all pairs; these sums and forests make link counts and components.

Defined cases: null vectors, vectors without a length, with null or non-finite components, or without a
label are linked with nothing; ties and repeated rows are rows of their own; an empty table gives an
empty result; other columns are not read, so none can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, materialize, numbered, ship
from courtload.llm.components import components, contracted

COSINE = 0.98
#: Vectors that the codebooks are fitted on, at most about.
SAMPLE = 20_000
#: Bytes of the sample as doubles, and vectors of it whose linked pairs within the sample are looked up.
SAMPLE_BYTES, QUERIED = 64 << 20, 4096
#: Part of the sample's linked pairs that the traversal covers, and how much farther it goes; with fewer pairs
#: than PAIRS it goes the whole radius, which misses none.
RECALL, MARGIN, PAIRS = 0.999, 1.25, 500
BLOCK = 256
#: Bytes of the copies that a worker hands on at a time, about.
BATCH_BYTES = 8 << 20
#: Centroids of a half: at least; beyond, so that a label's cells hold about PER_CELL vectors.
CENTROIDS, MOST_CENTROIDS, PER_CELL = 16, 1024, 64


#: Codebooks of the halves and the part of the radius that the traversal goes.
Book = tuple[np.ndarray, np.ndarray, float]


def unit(rows: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """(whether it can be linked, unit vector) of raw vectors."""
    out, fine = [], np.zeros(len(rows), bool)
    for i, v in enumerate(rows):
        x = np.array([], np.float64) if v is None or any(c is None for c in v) else np.array(v, np.float64)
        with np.errstate(all="ignore"):
            top = np.abs(x).max(initial=0.0)
            fine[i] = len(x) > 0 and np.isfinite(top) and top > 0
            x = x / top if fine[i] else x[:0]   # no overflow or underflow in the square
            out.append(x / np.sqrt((x * x).sum()) if fine[i] else x)
    return fine, out


def codebook(points: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spread starts."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    c = points[np.linspace(0, len(points) - 1, min(size, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = ((c ** 2).sum(1) - 2 * points @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, points)
        c[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return c


def depths(half: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, distance to the plane before each other centroid's cell) of half vectors."""
    d = ((half ** 2).sum(1)[:, None] - 2 * half @ book.T + (book ** 2).sum(1)).clip(0)
    home = d.argmin(1)
    square = (book ** 2).sum(1)
    apart = np.sqrt((square[:, None] - 2 * book @ book.T + square).clip(0))[home]
    depth = (d - d[np.arange(len(d)), home][:, None]) / (2 * np.maximum(apart, 1e-9))
    depth[np.arange(len(d)), home] = 0
    return home, depth.clip(0)


def traversal(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells in the order of first[i]**2 + second[j]**2, up to reach**2."""
    a, b = np.flatnonzero(first <= reach), np.flatnonzero(second <= reach)
    total = first[a][:, None] ** 2 + second[b][None] ** 2
    order = np.argsort(total, axis=None, kind="stable")
    order = order[total.ravel()[order] <= reach * reach]
    return list(zip(a[order // len(b)].tolist(), b[order % len(b)].tolist()))


def needed(x: np.ndarray, first: np.ndarray, second: np.ndarray, label: np.ndarray, cosine: float) -> np.ndarray:
    """How far, as a part of the radius, the traversal must go for each linked pair of some unit vectors to meet."""
    half = x.shape[1] // 2
    (h1, d1), (h2, d2) = depths(x[:, :half], first), depths(x[:, half:], second)
    own, out = h1 * len(second) + h2, []
    for a in range(0, min(len(x), QUERIED), BLOCK):
        i, j = np.nonzero(x[a:a + BLOCK] @ x.T >= cosine)
        i, j = i[i + a != j] + a, j[i + a != j]
        i, j = i[label[i] == label[j]], j[label[i] == label[j]]
        far, near = np.where(own[i] > own[j], i, j), np.where(own[i] > own[j], j, i)   # the cell with the lower number is visited
        out.append(np.sqrt(d1[far, h1[near]] ** 2 + d2[far, h2[near]] ** 2))
    return np.concatenate(out) / math.sqrt(2 - 2 * cosine) if out else np.zeros(0)


def _place_batches(batches: Iterable[pa.RecordBatch], books: dict[int, Book], cosine: float) -> Iterator[pa.RecordBatch]:
    radius = math.sqrt(2 - 2 * cosine)
    for batch in batches:
        kind, held = batch.schema.field(1).type, []

        def out() -> pa.RecordBatch:
            columns = zip(*held)
            types = (pa.int64(), kind, pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["row", "label", "size", "cell", "home", "vector"])
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            fine, units = unit(part.column(2).to_pylist())
            row, label = part.column(0).to_pylist(), part.column(1).to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, ok in enumerate(fine):
                if ok and label[i] is not None:
                    by_size.setdefault(len(units[i]), []).append(i)
            for size, at in by_size.items():
                x = np.stack([units[i] for i in at])
                first, second, reach = books.get(size) or (np.zeros((1, size // 2)), np.zeros((1, size - size // 2)), 1.0)
                (h1, d1), (h2, d2) = depths(x[:, :size // 2], first), depths(x[:, size // 2:], second)
                wide, limit = len(second), reach * radius + 1e-9
                for k, i in enumerate(at):
                    own, vector = int(h1[k]) * wide + int(h2[k]), units[i].tobytes()
                    for c in [own, *(c for a, b in traversal(d1[k], d2[k], limit) if (c := a * wide + b) < own)]:
                        held.append((row[i], label[i], size, c, c == own, vector))
                    if len(held) * (8 * size + 64) > BATCH_BYTES:
                        yield out()
                        held = []
        if held:
            yield out()


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (first of a part, other member) that connect what a symmetric matrix of links connects."""
    left, out = np.ones(len(linked), bool), []
    left &= linked.any(1)
    while left.any():
        start = int(left.argmax())
        reached, fresh = np.zeros(len(linked), bool), np.array([start])
        reached[start] = True
        while len(fresh):
            found = linked[fresh].any(0) & ~reached
            reached |= found
            fresh = np.flatnonzero(found)
        left &= ~reached
        out += [(start, int(i)) for i in np.flatnonzero(reached) if i != start]
    return out


def _compare(table: pa.Table, cosine: float) -> pa.Table:
    """Counts (b null) and spanning links of one pair of blocks."""
    t = table.combine_chunks()
    row, home = t["row"].to_numpy(), t["home"].to_numpy(zero_copy_only=False)
    block, pair = t["block"].to_numpy(), (t["low"][0].as_py(), t["high"][0].as_py())
    x = np.frombuffer(b"".join(t["vector"].to_pylist()), np.float64).reshape(len(row), -1)
    linked = (x @ x.T >= cosine) & (home[:, None] | home[None])
    if pair[0] != pair[1]:
        linked &= block[:, None] != block[None]
    np.fill_diagonal(linked, False)
    count = linked.sum(1)
    some = np.flatnonzero(count)
    edges = spanning(linked)
    a = np.concatenate([row[some], row[[i for i, _ in edges]]]).astype(np.int64)
    b = [None] * len(some) + [int(row[j]) for _, j in edges]
    n = np.concatenate([count[some], np.zeros(len(edges))]).astype(np.int64)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})


def fit(vectors: DataFrame, vector_col: str, label_col: str, key_cols: list[str], cosine: float = COSINE,
        sample: int = SAMPLE) -> dict[int, Book]:
    """Codebooks of both halves and the reach by dimension, from about ``sample`` vectors, and SAMPLE_BYTES, chosen by a hash of
    their key, which no two rows share."""
    known = vectors.where(F.col(vector_col).isNotNull() & F.col(label_col).isNotNull())
    n, labels, longest = known.agg(F.count("*"), F.approx_count_distinct(label_col), F.max(F.size(vector_col))).first()
    if not n:
        return {}
    sample = min(sample, SAMPLE_BYTES // (8 * max(longest, 1)) + 1)
    place = F.pmod(F.xxhash64(*key_cols), F.lit(1_000_000)) / 1_000_000
    rows = known.where(place < min(1.0, sample / n)).select(F.xxhash64(*key_cols).alias("key"), label_col, vector_col).toPandas()
    rows = rows.sort_values("key", kind="stable")
    fine, units = unit(list(rows[vector_col]))
    names = rows[label_col].factorize()[0]
    by_size: dict[int, list[np.ndarray]] = {}
    label_of: dict[int, list[int]] = {}
    for ok, u, name in zip(fine, units, names):
        if ok:
            by_size.setdefault(len(u), []).append(u)
            label_of.setdefault(len(u), []).append(name)
    out = {}
    for size, found in by_size.items():
        x = np.stack(found)
        centroids = min(MOST_CENTROIDS, max(CENTROIDS, math.ceil(math.sqrt(n / max(labels, 1) / PER_CELL))))
        first, second = codebook(x[:, :size // 2], centroids), codebook(x[:, size // 2:], centroids)
        seen = needed(x, first, second, np.array(label_of[size]), cosine)
        reach = MARGIN * float(np.quantile(seen, RECALL)) if len(seen) >= PAIRS else 1.0
        out[size] = first, second, min(reach, 1.0)
    return out


def groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; components by the smallest id reachable."""
    spark = vectors.sparkSession
    ship(spark)
    vectors, row = numbered(vectors.select(F.col(id_col), F.col(label_col), F.col(vector_col)), "vectors-numbered")
    books = fit(vectors, vector_col, label_col, [id_col, row], cosine)
    sent = spark.sparkContext.broadcast(books)   # bounded by the number of centroids
    placed = materialize(
        vectors.select(F.col(row), F.col(label_col), F.col(vector_col))
        .mapInArrow(lambda it: _place_batches(it, sent.value, cosine),
                    T.StructType([T.StructField("row", T.LongType()), T.StructField("label", field_type(vectors, label_col)),
                                  T.StructField("size", T.IntegerType()), T.StructField("cell", T.LongType()),
                                  T.StructField("home", T.BooleanType()), T.StructField("vector", T.BinaryType())])), "cells")
    key = ["label", "size", "cell"]
    blocks = materialize(placed.groupBy(key).agg(F.count("*").alias("n"), F.max("home").alias("lived"))
                         .where("lived AND n > 1").select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "cell-blocks")
    dealt = placed.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.least("block", "other")).withColumn(
        "high", F.greatest("block", "other")).drop("blocks", "other")
    found = materialize(dealt.groupBy(*key, "low", "high").applyInArrow(lambda t: _compare(t, cosine), "a long, b long, n long"),
                        "vector-links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n_links"))
    labels = components(contracted(found.where("b IS NOT NULL")))
    linked = materialize(counts.join(labels, counts.a == labels.node).select(F.col("a").alias("row"), "n_links", "component"),
                         "linked-vectors")
    every = vectors.select(F.col(row).alias("row"), F.col(id_col).alias("id"))
    joined = materialize(every.join(linked, "row", "left"), "vectors")
    firsts = materialize(joined.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("component_id")),
                         "vector-components")
    out = joined.join(firsts, "component", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
