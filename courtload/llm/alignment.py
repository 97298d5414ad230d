"""Alignment of two tokenizers by interval coalescing.

Both tokenizations of a text are intervals of its bytes.  All tokens of both are sorted by start, the ends are
accumulated to a running maximum, and a group breaks where a start reaches it; so a group is a least stretch that
whole tokens of both sides cover.  Within a group every token of one side meets the tokens of the other that it overlaps,
which expands to a list of overlaps; those that end together are links.  The texts of a block lie end to end, so
that a block is one sort.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model that puts a space in front; A
gets that space written out.  Special strings within texts are plain text.  Pieces of neither side cross
from a visible character to a space or a line end, so texts without other white space are encoded by units of white space
and what follows, each different unit once while a worker keeps it; the units kept are bounded in bytes.  Other texts
and other tokenizers are encoded whole.

``scores`` counts each pair of ids that is linked over the whole corpus.  Blocks of texts are written once, each with the list
of its different pairs and, for each link, its place in that list.  The lists are counted with partial sums, and what each
block's list has found comes back to the block: so a pair passes a shuffle once for a block and not for a link, and
no task needs the counts of all pairs.

Defined cases: texts that are null, empty, or that either tokenizer doesn't give back byte for byte have no tokens;
repeated rows, null and tied ids are rows like any other; long texts are blocks of their own; an empty table gives
an empty result; other columns are not read, so none can clash.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.bpe_chunks import ChunkEncoder
from courtload.llm.common import field_type, materialize, returned, scratch_path, ship
from courtload.llm.tokens import byte_char

#: Characters of the texts of a block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Bytes of units and their ids kept per worker, about, besides those of the last block.
KEPT_BYTES = 48 << 20
#: Units learnt as one text.
_LEARNT = 1 << 14

_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of any kind but the space and the line end.
_OTHER_WHITE = re.compile(r"[^\S \n]")
_UNITS = re.compile(r"[ \n]+[^ \n]*")


class _Side:
    """Ids of some units laid end to end, and where each unit's end."""

    def __init__(self) -> None:
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ends = np.append(self.ends, ends + len(self.ids))
        self.ids = np.append(self.ids, ids.astype(np.uint32))

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after the other, and how many each has."""
        start = np.append(0, self.ends)[units]
        size = self.ends[units] - start
        return self.ids[np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)], size


class TwoTokenizers:
    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # tasks share the machine's cores
        ranked = ChunkEncoder(a_path)
        self.a = ranked.tokenizer
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {byte_char(i): i for i in range(256)}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in t) if set(t) <= byte_of.keys() else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        #: Whether no piece of either side crosses from a visible character to a space or a line end.
        self.by_unit = (ranked.chunked and not any(re.search("[^▁]▁|\n", p) for p in pieces)
                        and self.b.encode("x") == self.b.encode("x y")[:1] and pieces[self.b.encode("\nx")[0]] == "▁")
        self.plain = ranked.plain if self.by_unit else None
        self.front = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.sides = _Side(), _Side()
        self.whole = np.zeros(0, bool)
        self.kept_bytes = 0

    def _alone(self, units: list[str]) -> None:
        """Learn texts that start with white space one by one."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        ids_b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for k, unit in enumerate(units):
            if unit[0] != " ":
                ids_b[k] = ids_b[k][1:]      # the space that B puts in front
            elif unit == " ":
                ids_b[k] = [self.front]      # B puts none in front of nothing
        whole = [b"".join(map(self.bytes_a.__getitem__, a)) == u.encode() == b"".join(map(self.bytes_b.__getitem__, b))
                 for u, a, b in zip(units, ids_a, ids_b)]
        for side, ids in zip(self.sides, (ids_a, ids_b)):
            side.add(np.array([i for one in ids for i in one], np.uint32), np.cumsum([len(one) for one in ids]))
        self._note(units, np.array(whole, bool))

    def _learn(self, units: list[str]) -> None:
        """Learn units that end in a visible character as one text; its tokens must end where the units do."""
        text = "".join(units)
        data = text.encode()
        ids = (self.plain.encode_to_numpy(text, disallowed_special=()), np.array(self.b.encode("x" + text), np.int64)[1:])
        limits = np.cumsum([len(u.encode()) for u in units])
        ends = []
        for side, lengths, entries in zip(ids, (self.length_a, self.length_b), (self.bytes_a, self.bytes_b)):
            to = np.cumsum(lengths[side])
            at = np.minimum(np.searchsorted(to, limits), len(to) - 1)
            if (to[at] != limits).any() or b"".join(map(entries.__getitem__, side.tolist())) != data:
                return self._alone(units)
            ends.append(at + 1)
        for side, found, end in zip(self.sides, ids, ends):
            side.add(found, end)
        self._note(units, np.ones(len(units), bool))

    def _note(self, units: list[str], whole: np.ndarray) -> None:
        self.kept.update(zip(units, range(len(self.whole), len(self.whole) + len(units))))
        self.whole = np.append(self.whole, whole)
        self.kept_bytes += sum(map(len, units)) + 200 * len(units)   # text, entry and ids, about

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, number of each text's) for A and for B, each text with a space in front; none where a side doesn't give the bytes back."""
        if self.kept_bytes > KEPT_BYTES:
            self._forget()
        split = [[] if not t else _UNITS.findall(" " + t) if self.by_unit and not _OTHER_WHITE.search(t) else [" " + t]
                 for t in texts]
        new = sorted(set().union(*split).difference(self.kept))
        odd = [u for u in new if not self.by_unit or u[-1] in " \n" or _OTHER_WHITE.search(u)]
        if odd:
            self._alone(odd)
            new = sorted(set(new).difference(odd))
        for k in range(0, len(new), _LEARNT):
            self._learn(new[k:k + _LEARNT])
        units = np.fromiter(map(self.kept.__getitem__, chain.from_iterable(split)), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        good = np.bincount(owner, ~self.whole[units], len(texts)) == 0
        units, owner = units[good[owner]], owner[good[owner]]
        out = []
        for side in self.sides:
            ids, size = side.of(units)
            out.append((ids, np.bincount(owner, size, len(texts)).astype(np.int64)))
        return out


@functools.lru_cache(1)
def two_tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    """One pair per worker process, kept between its tasks."""
    return TwoTokenizers(a_path, b_path)


class Aligned(NamedTuple):
    """Tokens of a block's texts: group of each token on either side, and overlaps as (A token, B token, whether they end together)."""

    group_a: np.ndarray
    group_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    together: np.ndarray


def coalesce(length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Groups and overlaps of two rows of intervals that cover the same bytes, given the lengths."""
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    start_a, start_b = end_a - length_a, end_b - length_b
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    side = np.repeat([0, 1], [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    group = np.zeros(len(order), np.int64)
    group[order[1:]] = np.cumsum(start[order[1:]] >= reach[:-1])
    # the overlaps of an A token: B tokens from the first that ends after its start to the last that starts before its end
    first, last = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    times = last - first
    a = np.repeat(np.arange(len(end_a)), times)
    b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times - first, times)
    return Aligned(group[:len(end_a)], group[len(end_a):], a, b, end_a[a] == end_b[b])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of blocks of rows."""
    for batch in batches:
        held, at, n = [], 0, 0
        for row in range(batch.num_rows):
            text = batch.column(1)[row].as_py() or ""
            if held and n + len(text) > BLOCK:
                yield batch.column(0).slice(at, len(held)), held
                held, at, n = [], row, 0
            held.append(text)
            n += len(text)
        if held:
            yield batch.column(0).slice(at), held


@functools.lru_cache(1)
def _decimals(n: int) -> list[str]:
    """Ids below n with what follows them: nothing, a comma, a bar or a semicolon."""
    return [f"{i}{c}" for c in ("", ",", "|", ";") for i in range(n)]


def _listings(ids_a: np.ndarray, ids_b: np.ndarray, aligned: Aligned, n: int) -> tuple[list[str], np.ndarray]:
    """Each token's id with what follows it, by group and side, and the group of each."""
    key = np.concatenate([aligned.group_a * 2, aligned.group_b * 2 + 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    after = np.full(len(key), 3)
    after[:-1] = np.where(key[1:] == key[:-1], 1, np.where(key[1:] >> 1 == key[:-1] >> 1, 2, 3))
    ids = np.concatenate([ids_a, ids_b])[order].astype(np.int64)
    return list(map(_decimals(n).__getitem__, (after * n + ids).tolist())), key >> 1


class _Block(NamedTuple):
    ids_a: np.ndarray
    ids_b: np.ndarray
    aligned: Aligned
    #: Ends of each text's A tokens, B tokens and groups.
    to_a: np.ndarray
    to_b: np.ndarray
    to_group: np.ndarray


def _aligned(tokenizers: TwoTokenizers, texts: list[str]) -> _Block:
    (ids_a, n_a), (ids_b, n_b) = tokenizers.encode(texts)
    aligned = coalesce(tokenizers.length_a[ids_a], tokenizers.length_b[ids_b])
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    to_group = np.append(0, aligned.group_a + 1)[to_a]
    return _Block(ids_a, ids_b, aligned, to_a, to_b, to_group)


def _pair_batches(batches: Iterable[pa.RecordBatch], a_path: str, b_path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each block: its texts' numbers, its different linked pairs, and the place of each link's pair."""
    tokenizers = two_tokenizers(a_path, b_path)
    block = TaskContext.get().partitionId() << 33
    most = max(len(tokenizers.bytes_a), len(tokenizers.bytes_b))
    for ids, texts in _blocks(batches):
        b = _aligned(tokenizers, texts)
        together = b.aligned.together
        link_a, link_b = b.aligned.a[together], b.aligned.b[together]
        pairs, at, n = np.unique(b.ids_a[link_a].astype(np.int64) << 32 | b.ids_b[link_b], return_inverse=True, return_counts=True)
        to_link = np.searchsorted(link_a, b.to_a)
        listed, group = _listings(b.ids_a, b.ids_b, b.aligned, most)
        to_listed = np.searchsorted(group, b.to_group).tolist()
        digests = [hashlib.sha256("".join(listed[x:y])[:-1].encode()).hexdigest() if y > x else ""
                   for x, y in zip([0, *to_listed], to_listed)]
        numbers = [np.diff(to, prepend=0) for to in (b.to_a, b.to_b, b.to_group, to_link)]
        size = np.uint16 if len(pairs) <= 1 << 16 else np.uint32
        docs = pa.StructArray.from_arrays([ids, *map(pa.array, numbers), pa.array(digests, pa.string())],
                                          fields=list(schema.field("docs").type.value_type))
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.ListArray.from_arrays([0, len(texts)], docs), pa.array([at.astype(size).tobytes()], pa.binary()),
             pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([n.tolist()], pa.list_(pa.int64()))], schema=schema)
        block += 1


def _scored(block: pa.Table, counts: pa.Table, names: list[str]) -> pa.Table:
    """A row for each text of a block, from its links and the counts of its pairs."""
    docs, links = block["docs"].combine_chunks().flatten(), block["links"][0].as_py()
    order = np.argsort(counts["slot"].to_numpy())
    number, best = counts["count"].to_numpy()[order], counts["best"].to_numpy()[order]
    at = np.frombuffer(links, np.uint16 if len(number) <= 1 << 16 else np.uint32)
    n_links = docs.field("n_links").to_numpy()
    to = np.append(0, np.cumsum(n_links))
    sums, bests = (np.append(0, np.cumsum(x[at].astype(np.int64)))[to] for x in (number, best))
    return pa.Table.from_arrays([*docs.flatten(), pa.array(np.diff(bests)), pa.array(np.diff(sums))],
                                names=[*(f.name for f in docs.type), "n_best", "count_sum"]).select(names)


def scores(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A link's count is how often its pair of ids is linked in all texts; ``n_best`` are the links whose count is the highest of
    their B id.  ``a_path`` and ``b_path`` are files on every machine.
    """
    spark = docs.sparkSession
    ship(spark)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    doc = T.StructType([T.StructField("id", field_type(docs, id_col)), *[T.StructField(c, T.LongType()) for c in numbers],
                        T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(doc)),
                           T.StructField("links", T.BinaryType()), T.StructField("pairs", T.ArrayType(T.LongType())),
                           T.StructField("times", T.ArrayType(T.LongType()))])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    path = scratch_path(spark, "alignment")
    # blocks are rows of some MB: small row groups keep few of them in memory
    docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_pair_batches(it, a_path, b_path, arrow)), schema).write.option("parquet.block.size", 16 << 20).parquet(path)
    blocks, lists = (spark.read.schema(schema).parquet(path) for _ in range(2))
    listed = lists.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("slot", "p")).select(
        "block", "slot", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = materialize(listed.groupBy("pair").agg(F.sum("times").alias("count")).withColumn(
        "b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    rated = counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    back = listed.select("block", "slot", "pair").join(rated, "pair").select("block", "slot", "count", "best")
    names = ["id", *numbers, "n_best", "count_sum", "groups_sha256"]
    out = T.StructType([T.StructField(c, doc["id"].dataType if c == "id" else T.StringType() if c == "groups_sha256" else T.LongType())
                        for c in names])
    return blocks.select("block", "docs", "links").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        lambda block, counts: _scored(block, counts, names), out).withColumnRenamed("id", id_col)


_SPAN = T.StructType([T.StructField(c, T.IntegerType()) for c in ("a_start", "a_end", "b_start", "b_end")])
_MEETING = T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "b")])


def _align_batches(batches: Iterable[pa.RecordBatch], a_path: str, b_path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    tokenizers = two_tokenizers(a_path, b_path)

    def lists(values: pa.Array, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values).cast(kind)
    for ids, texts in _blocks(batches):
        x = _aligned(tokenizers, texts)
        size_a, size_b = np.diff(x.to_a, prepend=0), np.diff(x.to_b, prepend=0)
        base_a, base_b = x.to_a - size_a, x.to_b - size_b
        doc = np.repeat(np.arange(len(texts)), np.diff(x.to_group, prepend=0))
        edges = [np.searchsorted(g, np.arange(len(doc)), how) - base[doc] for g, base in
                 ((x.aligned.group_a, base_a), (x.aligned.group_b, base_b)) for how in ("left", "right")]
        own = np.repeat(np.arange(len(texts)), size_a)[x.aligned.a]
        meeting = [x.aligned.a - base_a[own], x.aligned.b - base_b[own]]
        spans, pairs = (pa.StructArray.from_arrays([pa.array(v.astype(np.int32)) for v in values], names=names)
                        for values, names in ((edges, _SPAN.names), (meeting, _MEETING.names)))
        kinds = [schema.field(k).type for k in range(1, 5)]
        yield pa.RecordBatch.from_arrays(
            [ids, lists(pa.array(x.ids_a.astype(np.int32)), x.to_a, kinds[0]), lists(pa.array(x.ids_b.astype(np.int32)), x.to_b, kinds[1]),
             lists(spans, x.to_group, kinds[2]), lists(pairs, np.searchsorted(x.aligned.a, x.to_a), kinds[3])], schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids_a, ids_b, groups, overlaps) of every row.

    Groups are ranges of token numbers (ends exclusive) on both sides; overlaps are pairs of token numbers that share a byte.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("ids_a", T.ArrayType(T.IntegerType())),
                           T.StructField("ids_b", T.ArrayType(T.IntegerType())), T.StructField("groups", T.ArrayType(_SPAN)),
                           T.StructField("overlaps", T.ArrayType(_MEETING))])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_align_batches(it, a_path, b_path, arrow)), schema)
