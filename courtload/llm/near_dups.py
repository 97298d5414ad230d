"""Near-duplicate groups of documents by ProbMinHash, banding and verification.

A document is its shingles of five words (lower-cased, split at white space; a shorter text is one
shingle of all its words), each of weight 1 however often it comes, as links are decided by the plain Jaccard
similarity.  Its signature is ProbMinHash: every shingle throws exponential arrivals at the rate of its
weight into slots in an order of its own, without repeats; a slot keeps the shingle that arrives first,
and a shingle stops once it is later than all slots' arrivals so far.  Two signatures agree in a slot with
the probability Jaccard of the shingles.  BANDS bands of ROWS slots make the buckets: a pair of similarity 0.8 shares none
with probability (1 - 0.8**ROWS)**BANDS, 5e-5.

Documents with the same shingles are one document from then on.  In each bucket all members are compared with
a pivot, the first of them, so a bucket of n gives n - 1 pairs and not n**2.  Pairs are verified by the exact
Jaccard similarity of the shingles, of 64 bits each; links make connected components.  Then every pair of a bucket's
members is compared that wasn't compared with the pivot and has its ends in different components, in blocks of BLOCK
members (or BLOCK_BYTES of shingles) against each other; a pair of several buckets in the one of its first band.
So each pair that shares a bucket is verified or in one component.  No bucket is capped.

Defined cases: null, empty and blank texts have no shingles and are alike with nothing; ties and
repeated rows: of a group the row with the smallest id stays (null ids last), then the first read;
an empty table gives an empty result; other columns are not read by ``classes`` and come through
``keep_one`` whatever their names.
"""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import BROADCAST_ROWS, by_row, field_type, materialize, numbered, outlasting, returned, run_intermediates, ship
from courtload.llm.components import components, contracted

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
#: Members, and bytes of their shingles, of a bucket in a block on average.
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: Slots; a prime, so that steps of any length visit each once.
SLOTS = 127
#: Texts hashed together.
_TEXTS = 256
#: Shingles counted together for two blocks.
_SHINGLES = 4096
_P = np.uint64(0x9FB21C651E98DF25)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the different shingles of some texts, by text and hash."""
    split = [(t or "").lower().split() for t in texts]
    size = np.array([len(s) for s in split], np.int64)
    flat = [w for s in split for w in s]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    owner = np.repeat(np.arange(len(texts)), size)
    start = np.cumsum(size) - size
    place = np.arange(len(flat)) - start[owner]
    key = np.zeros(len(flat), np.uint64)
    for k in range(words):   # shorter texts stop at their end
        inside = place + k < size[owner]
        shifted = np.zeros(len(flat), np.uint64)
        shifted[:max(len(flat) - k, 0)] = h[k:]
        key = np.where(inside, key * _P + shifted + np.uint64(1), key)
    first = (place + words <= size[owner]) | (place == 0)
    owner, key = owner[first], mixed(key[first])
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], key[at], np.diff(np.append(at, len(key)))


def signatures(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """ProbMinHash signatures (texts x slots) of weighted shingles; rows of texts without shingles are 0."""
    best = np.full(texts * slots, np.inf)
    kept = np.zeros(texts * slots, np.uint64)
    first = (mixed(key ^ np.uint64(0xA5A5A5A5)) % np.uint64(slots)).astype(np.int64)
    step = (mixed(key ^ np.uint64(0x5A5A5A5A)) % np.uint64(slots - 1)).astype(np.int64) + 1
    now, number = np.zeros(len(key)), 0
    while len(key):
        u = (mixed(key + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)).astype(np.float64)
        now = now - np.log((u + 0.5) * 2.0 ** -53) / (weight * (slots - number))
        at = owner * slots + (first + number * step) % slots
        np.minimum.at(best, at, now)
        won = best[at] == now
        kept[at[won]] = key[won]
        number += 1
        if number == slots:
            break
        live = now < best.reshape(texts, slots).max(1)[owner]
        owner, key, weight, now, first, step = (x[live] for x in (owner, key, weight, now, first, step))
    return kept.reshape(texts, slots)


def band_keys(kept: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(kept), bands)) * _P
    for k in range(rows):
        key = mixed(key * _P + kept[:, k:bands * rows:rows])
    return key.view(np.int64)


def _sign_batches(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(a, _TEXTS)
            owner, key, _ = shingles(part.column(2).to_pylist(), words)
            keys = band_keys(signatures(owner, key, np.ones(len(key)), part.num_rows))
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            prints = [xxhash.xxh3_128_digest(key[x:y].tobytes()) if y > x else None for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(prints, pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                names=["row", "id", "print", "bands"])


def _set_batches(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(a, _TEXTS)
            owner, key, _ = shingles(part.column(1).to_pylist(), words)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([key[x:y].tobytes() for x, y in zip(ends, ends[1:])], pa.binary())],
                names=["row", "keys"])


def jaccard(a: bytes, b: bytes) -> float:
    """Similarity of two sets given as sorted 64-bit keys; 0 if one is empty."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return both / (len(x) + len(y) - both)


def _link_batches(batches: Iterable[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(k, _TEXTS)
            a, b = (c.to_pylist() for c in part.columns[2:4])
            linked = pa.array([jaccard(x, y) >= similarity for x, y in zip(a, b)], pa.bool_())
            yield part.select(["a", "b"]).filter(linked)


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    left, right = (sets.select(F.col("row").alias(c), F.col("keys").alias(f"keys_{c}")) for c in "ab")
    found = pairs.join(left, "a").join(right, "b").select("a", "b", "keys_a", "keys_b")
    return materialize(found.mapInArrow(lambda it: returned(_link_batches(it, similarity)), "a long, b long"), "near-links")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of some sets with each of others."""
    sizes = [len(x) for x in (*left, *right)]
    key, at, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1   # a shingle of one set only is in no intersection
    row, col = np.repeat(np.arange(len(sizes)), sizes)[times[at] > 1], place[at[times[at] > 1]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(left), len(right)), np.float32)   # exact up to 2**24 shingles
    for k in range(0, int(col[-1]) + 1 if len(col) else 0, _SHINGLES):
        x, y = np.searchsorted(col, [k, k + _SHINGLES])
        held = np.zeros((len(sizes), _SHINGLES), np.float32)
        held[row[x:y], col[x:y] - k] = 1
        both += held[:len(left)] @ held[len(left):].T
    return both


def _block_links(table: pa.Table, similarity: float) -> pa.Table:
    """Different (a, b) of components that a pair of a unit links."""
    bucket, diagonal = table["bucket"][0].as_py(), table["i"][0] == table["j"][0] and table["kind"][0].as_py() == 0
    component = table["component"].to_numpy()
    bands = np.array(table["bands"].to_pylist(), np.int64)
    size = table["size"].to_numpy()
    right = table["right"].to_numpy(zero_copy_only=False)
    x = np.flatnonzero(~right)
    y = np.arange(len(right)) if diagonal else np.flatnonzero(right)
    open_ = component[x][:, None] != component[y]
    open_ &= np.minimum(size[x][:, None], size[y]) >= similarity * np.maximum(size[x][:, None], size[y])
    if diagonal:
        open_ &= (x[:, None] < y) | right[y]
    for k in range(bands.shape[1]):
        if (bands[:, k] == bucket).all():
            break
        open_ &= bands[x, k][:, None] != bands[y, k]   # theirs in an earlier band
    used_x, used_y = open_.any(1), open_.any(0)
    x, y, open_ = x[used_x], y[used_y], open_[used_x][:, used_y]
    found = np.zeros((0, 2), np.int64)
    if len(x):
        keys = table["keys"]
        sets = {k: np.frombuffer(keys[k].as_py(), np.uint64) for k in {*x.tolist(), *y.tolist()}}
        if int(size.max()) < 1 << 24:
            both = common([sets[k] for k in x.tolist()], [sets[k] for k in y.tolist()]).astype(np.float64)
            linked = open_ & (both / (size[x][:, None] + size[y] - both) >= similarity)
        else:
            linked = open_.copy()
            for i, j in np.argwhere(open_):
                linked[i, j] = jaccard(sets[int(x[i])], sets[int(y[j])]) >= similarity
        i, j = np.nonzero(linked)
        ends = component[x[i]], component[y[j]]
        found = np.unique(np.stack([np.minimum(*ends), np.maximum(*ends)], 1), axis=0)
    return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})


def _units(kind: int, start: int, count: Column, unit: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
    """Array of (kind, i, j, right) for each block from ``start`` to below ``count``."""
    def one(k: Column) -> Column:
        i, j, right = unit(k)
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), right.alias("right"))
    blocks = F.filter(F.sequence(F.lit(0), count.cast("int")), lambda k: (k >= start) & (k < count))
    return F.transform(blocks, one)


def _rest_links(left: DataFrame, pivots: DataFrame, labels: DataFrame, singles: DataFrame, sets: DataFrame,
                similarity: float) -> DataFrame:
    """Links (a, b) between components by the pairs of a bucket without its pivot, all that end in two components.

    Open members are those outside the pivot's component.  Units of work are two blocks of open members, or one
    of these and one of the others (the first of these along with the open block itself).
    """
    def of(rows: DataFrame) -> DataFrame:
        return rows.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
            "bucket", "row", F.coalesce("component", "row").alias("component"))
    mains = of(pivots).select("bucket", F.col("row").alias("pivot"), F.col("component").alias("main"))
    rest = of(left).join(mains, "bucket").where("row <> pivot").withColumn("open", F.col("component") != F.col("main"))
    rest = materialize(rest.select("bucket", "row", "component", "open"), "rest")
    # buckets with an open member and another one beside the pivot
    counts = rest.groupBy("bucket").agg(F.count_if("open").alias("opens"), F.count("*").alias("n")).where("opens > 0 AND n > 1")
    rest = rest.join(counts.select("bucket"), "bucket").join(sets.select("row", "size"), "row")
    rest = materialize(rest, "rest-open")

    def blocks(which: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(which) / F.lit(BLOCK), F.sum(F.when(which, F.col("size") * 8)) / F.lit(BLOCK_BYTES)))
    dealt = rest.groupBy("bucket").agg(blocks(F.col("open")).alias("opens"), F.coalesce(blocks(~F.col("open")), F.lit(0)).alias("others"))
    opens, others, block = F.col("opens"), F.col("others"), F.col("block")
    no, yes = F.lit(False), F.lit(True)
    to = F.when(F.col("open"), F.concat(
        _units(0, 0, opens, lambda k: (F.least(k, block), F.greatest(k, block), k < block)),
        _units(1, 1, others, lambda k: (block, k, no)))).otherwise(
        F.when(block == 0, _units(0, 0, opens, lambda k: (k, k, yes))).otherwise(_units(1, 0, opens, lambda k: (k, block, yes))))
    units = rest.join(dealt, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("bucket", "row"), F.when(F.col("open"), opens).otherwise(others))).select(
        "bucket", "row", "component", "size", F.inline(to))
    units = units.join(sets.select("row", "keys"), "row").join(singles.select("row", "bands"), "row")
    return materialize(units.groupBy("bucket", "kind", "i", "j").applyInArrow(
        lambda table: _block_links(table, similarity), "a long, b long").distinct(), "rest-links")


def candidates(docs: DataFrame, singles: DataFrame, text_col: str, words: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows (row, bucket) of the buckets with several of ``singles`` (row, bands), and the shingles of these rows; None if
    no two share a bucket.  Texts are not read after that."""
    member = singles.select("row", F.explode("bands").alias("bucket"))
    crowded = materialize(member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "buckets")
    left = materialize(member.join(crowded, "bucket"), "bucket-rows")
    some = materialize(left.select("row").distinct(), "near-candidates")
    n = some.count()
    if not n:
        return None
    text = docs.select("row", F.col(text_col).cast("string").alias("text"))
    sets = materialize(text.join(F.broadcast(some) if n <= BROADCAST_ROWS else some.hint("merge"), "row", "left_semi").mapInArrow(
        lambda it: returned(_set_batches(it, words)), "row long, keys binary").withColumn("size", (F.length("keys") / 8).cast("long")), "shingle-sets")
    return left, sets


def links(left: DataFrame, sets: DataFrame, singles: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of the linked documents among ``candidates``."""
    pivots = materialize(left.groupBy("bucket").agg(F.min("row").alias("row")), "pivots")
    met = left.join(pivots.withColumnRenamed("row", "pivot"), "bucket").where("row <> pivot")
    pairs = met.select(F.least("row", "pivot").alias("a"), F.greatest("row", "pivot").alias("b")).distinct()
    labels = components(contracted(_links(pairs, sets, similarity)))
    return components(contracted(_rest_links(left, pivots, labels, singles, sets, similarity), labels), labels)


def _read_texts(texts: DataFrame, id_type: T.DataType, words: int) -> tuple[DataFrame, DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Signatures of every row (row, id, text), one row of each different set of shingles, and the ``candidates`` among these."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", id_type),
                           T.StructField("print", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    every = materialize(texts.select("row", "id", "text")
                        .mapInArrow(lambda it: returned(_sign_batches(it, words)), schema), "signatures")
    prints = materialize(every.where("print IS NOT NULL").groupBy("print").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "bands")).alias("first")), "prints")
    return every, prints, candidates(texts, prints.select("first.row", "first.bands"), "text", words)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
            similarity: float = SIMILARITY, row_col: str | None = None) -> DataFrame:
    """(row, id, class_id, class_size, kept) of every row; class_id is the smallest id of its group.

    ``row`` is the number in ``row_col`` of a written table if given; else the rows are numbered in a copy of ids and texts.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        *([] if row_col is None else [F.col(row_col).alias("row")]))
    outside = contextvars.copy_context()
    with run_intermediates(docs.sparkSession, "near-texts"):   # the copy of the texts goes once their shingles are written
        if row_col is None:
            texts, _ = numbered(texts, "texts-numbered")
        every, prints, found = outside.run(_read_texts, texts, field_type(docs, id_col), words)
    labels = None if found is None else links(*found, prints.select("first.row", "first.bands"), similarity)
    groups = prints.select("print", "n", F.col("first.row").alias("node"))
    groups = groups.withColumn("component", F.lit(None).cast("long")) if labels is None else groups.join(labels, "node", "left")
    groups = materialize(groups.where("n > 1 OR component IS NOT NULL").select(
        "print", F.coalesce("component", "node").alias("component")), "print-components")
    member = materialize(every.select("row", "id", "print").join(groups, "print", "left").select("row", "id", "component"), "near-members")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    firsts = materialize(member.where("component IS NOT NULL").groupBy("component").agg(
        F.count("*").alias("class_size"), best.alias("best")), "near-classes")
    joined = member.join(firsts, "component", "left")
    alone = F.col("best").isNull()
    return joined.select("row", F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("class_id"),
                         F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                         F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all its columns."""
    docs, row = numbered(docs, "texts-numbered")
    dropped = outlasting(docs.sparkSession, "near-copies", lambda: classes(docs, id_col, text_col, row_col=row).where(~F.col("kept")).select("row"))
    return by_row(docs, row, dropped, "left_anti")
