"""Exact deduplication by deterministic block naming.

Every text, without ``[\\x20\\x09-\\x0D]``, is cut into blocks of a fixed number of bytes.  Blocks are dealt
by content, sorted, and named by their rank within the task plus the task's number: equal blocks get
one name, different blocks different ones, as whole contents are compared.  Then adjacent pairs of names
are named in the same way, level by level, until each text has a single name.  Texts of one depth and
name are equal, without any hash to trust.

A block that repeats within one batch of rows is shuffled once and its other rows refer to it; pairs
are made distinct before the shuffle that names them.  So a text that a third of all rows hold sends
each task about as many rows as there are batches.  Names are written to the shared checkpoint folder
at each level; the joins that bring them back have plain exchanges on both sides, which adaptive
execution splits at hot keys.

Defined cases: null text counts as empty, and all empty texts are equal; of equal texts the row with
the most code points stays, then the smallest id (null ids last), then the first row read; repeated
rows are rows of their own, of which one stays; an empty table gives an empty result; other columns
are not read by ``groups`` and come through ``keep_first`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import by_row, field_type, materialize, numbered, outlasting, returned, ship

BLOCK_BYTES = 4096
_WHITE = b" \t\n\x0b\x0c\r"
#: Names of a task are its number times this plus the rank.
_TASK = 1 << 33


def _cut_batches(batches: Iterable[pa.RecordBatch], size: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of blocks, with the place of the first equal one of the batch; the first ones have their contents."""
    info_type = pa.struct([pa.field("id", id_type), pa.field("sha", pa.string()), pa.field("chars", pa.int64())])
    for batch in batches:
        rows, at, blocks, ref_rows, ref_at, info, seen = [], [], [], [], [], [], {}
        ids = batch.column(1).to_pylist()
        for row, doc, text in zip(batch.column(0).to_pylist(), ids, batch.column(2).to_pylist()):
            data = (text or "").encode().translate(None, _WHITE)
            for k, a in enumerate(range(0, max(len(data), 1), size)):
                block = data[a:a + size]
                first = seen.setdefault(block, (row, k))
                rows.append(row)
                at.append(k)
                blocks.append(block if first == (row, k) else None)
                ref_rows.append(first[0])
                ref_at.append(first[1])
                info.append({"id": doc, "sha": hashlib.sha256(data).hexdigest(), "chars": len(text or "")}
                            if not k else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(blocks, pa.binary()),
             pa.array(ref_rows, pa.int64()), pa.array(ref_at, pa.int32()), pa.array(info, info_type)],
            names=["row", "at", "block", "ref_row", "ref_at", "info"])


def _name_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of blocks that come in order."""
    name, last = TaskContext.get().partitionId() * _TASK - 1, None
    for batch in batches:
        names = []
        for block in batch.column(2).to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.int64())],
                                         names=["row", "at", "name"])


def _gathered(names: DataFrame) -> DataFrame:
    """One row per text with its names in order."""
    listed = F.sort_array(F.collect_list(F.struct("at", "name")))
    return names.groupBy("row").agg(F.transform(listed, lambda x: x["name"]).alias("names"), F.max("info").alias("info"))


def _paired(texts: DataFrame) -> DataFrame:
    """(row, at, a, b, info) of the adjacent pairs; b is null behind an odd last name."""
    n = F.size("names")
    pairs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int")),
                        lambda k: F.struct(k.alias("at"), F.get("names", 2 * k).alias("a"),
                                           F.get("names", 2 * k + 1).alias("b")))
    return texts.select("row", "info", F.explode(pairs).alias("p")).select(
        "row", "p.at", "p.a", F.coalesce("p.b", F.lit(-1)).alias("b"), F.when(F.col("p.at") == 0, F.col("info")).alias("info"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """(row, info, depth, name) of every row; info has its id, sha and chars.  (depth, name) is the text's identity.

    ``row`` is the number in ``row_col`` if given, else one made here: texts are read and cut in one pass, whose rows are written, so
    no second pass has to find the same rows in the same places.
    """
    ship(docs.sparkSession)
    id_type = field_type(docs, id_col)
    cut_type = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("block", T.BinaryType()),
        T.StructField("ref_row", T.LongType()), T.StructField("ref_at", T.IntegerType()),
        T.StructField("info", T.StructType([T.StructField("id", id_type), T.StructField("sha", T.StringType()),
                                            T.StructField("chars", T.LongType())]))])
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_id = to_arrow_type(id_type)
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    every = materialize(docs.select(row.alias("row"), F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_cut_batches(it, block_bytes, arrow_id)), cut_type), "blocks")
    named = materialize(
        every.where(F.col("block").isNotNull()).select("row", "at", "block").repartition("block").sortWithinPartitions("block")
        .mapInArrow(_name_batches, "row long, at int, name long"), "block-names")
    every = every.select("row", "at", "ref_row", "ref_at", "info")
    texts = materialize(_gathered(every.join(named.select(F.col("row").alias("ref_row"), F.col("at").alias("ref_at"), "name"),
                                             ["ref_row", "ref_at"]).select("row", "at", "name", "info")), "texts-0")
    depth, done = 0, []
    while True:
        done.append(texts.where(F.size("names") == 1).select("row", "info", F.lit(depth).alias("depth"),
                                                            F.get("names", F.lit(0)).alias("name")))
        longer = texts.where(F.size("names") > 1)
        if longer.isEmpty():
            break
        depth += 1
        pairs = materialize(_paired(longer), f"pairs-{depth}")
        ranks = materialize(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
                            .withColumn("name", F.monotonically_increasing_id()), f"pair-names-{depth}")
        texts = materialize(_gathered(pairs.join(ranks, ["a", "b"]).select("row", "at", "name", "info")), f"texts-{depth}")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
           row_col: str | None = None) -> DataFrame:
    """(row, id, keep_id, group_size, kept, text_sha256) of every row."""
    every = materialize(identities(docs, id_col, text_col, block_bytes, row_col), "identities")
    best = F.min(F.struct((-F.col("info.chars")).alias("c"), F.col("info.id").isNull().alias("n"),
                          F.col("info.id").alias("id"), F.col("row").alias("row")))
    shared = materialize(every.groupBy("depth", "name").agg(F.count("*").alias("group_size"), best.alias("best"))
                         .where("group_size > 1"), "groups")
    joined = every.join(shared, ["depth", "name"], "left")
    grouped = F.col("best").isNotNull()
    return joined.select(
        "row", F.col("info.id").alias(id_col), F.when(grouped, F.col("best.id")).otherwise(F.col("info.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"), F.col("info.sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    docs, row = numbered(docs, "texts-numbered")
    copies = outlasting(docs.sparkSession, "copies", lambda: groups(docs, id_col, text_col, row_col=row).where(~F.col("kept")).select("row"))
    return by_row(docs, row, copies, "left_anti")
