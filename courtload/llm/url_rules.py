"""URL rules in a sorted digest array.

The rule strings are kept in one file: 64-bit xxhash keys in ascending order,
verdicts, string offsets and the full strings.  Every task maps that file into
memory, probes it with a vectorised binary search and confirms each hit
against the stored string, so a digest collision never gives a verdict.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts
with the rule's path.  The candidates of a URL are therefore its host suffixes
at label ends times its path prefixes of the lengths that occur in the rules.
The longest fitting rule wins (ties: the longer host); the same string in both
lists blocks.  A URL that no rule fits gets the default verdict.

Defined cases: null or no ``://``: host and path empty, default verdict; an
empty table gives an empty result; repeated rows are judged each; columns of
the input other than id and URL don't come through, so none can clash.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, ship

#: Rules of at most so many characters in total go to the executors as one mapped file; more are joined.
ARRAY_CHARS = 256_000_000
_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) of a URL; both empty for null or no ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_ASCII_LOWER), path[:stop]


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(_ASCII_LOWER), slash + path


def candidates(host: str, path: str, lengths: Sequence[int]) -> Iterator[str]:
    """Every rule string that could fit, for rule paths of these lengths."""
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    while host and prefixes:
        for p in prefixes:
            yield host + p
        _, dot, host = host.partition(".")
        if not dot:
            return


def write_array(rules: dict[str, bool], path: str) -> None:
    """rules: normalised rule string -> blocks.  Digest order, strings of one digest in string order."""
    order = sorted(rules, key=lambda r: (xxhash.xxh64_intdigest(r), r))
    blobs = [r.encode() for r in order]
    ends = np.cumsum([0, *map(len, blobs)], dtype=np.uint64)
    with Path(path).open("wb") as f:
        f.write(np.array([len(order)], np.uint64).tobytes())
        f.write(np.array([xxhash.xxh64_intdigest(r) for r in order], np.uint64).tobytes())
        f.write(ends.tobytes())
        f.write(np.array([rules[r] for r in order], np.uint8).tobytes())
        f.write(b"".join(blobs))


class DigestArray:
    """The mapped file of ``write_array``."""

    def __init__(self, path: str) -> None:
        n = int(np.fromfile(path, np.uint64, 1)[0])
        mapped = np.memmap(path, np.uint8, "r")
        self.keys = mapped[8:8 + 8 * n].view(np.uint64)
        self.ends = mapped[8 + 8 * n:16 + 16 * n].view(np.uint64)
        self.blocks = mapped[16 + 16 * n:16 + 17 * n]
        self.blob = mapped[16 + 17 * n:]

    def find(self, strings: list[str]) -> np.ndarray:
        """Index of each string, -1 if it isn't stored."""
        wanted = np.fromiter((xxhash.xxh64_intdigest(s) for s in strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, wanted)
        out = np.full(len(strings), -1, np.int64)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        hits = np.flatnonzero(self.keys[near] == wanted) if len(self.keys) else []
        for i in hits:
            k, stored = int(at[i]), strings[i].encode()
            while k < len(self.keys) and self.keys[k] == wanted[i]:   # all strings of this digest
                if self.blob[int(self.ends[k]):int(self.ends[k + 1])].tobytes() == stored:
                    out[i] = k
                    break
                k += 1
        return out


def _judge_batches(batches: Iterable[pa.RecordBatch], file: str, lengths: list[int], spelt: dict[str, str],
                   default: str, schema: pa.Schema | None = None) -> Iterator[pa.RecordBatch]:
    array = DigestArray(SparkFiles.get(file))
    for batch in batches:
        parts = [split_url(u) for u in batch.column(1).to_pylist()]
        owners, strings = [], []
        for i, (host, path) in enumerate(parts):
            for c in candidates(host, path, lengths):
                owners.append((i, len(c), len(c) - c.find("/")))
                strings.append(c)
        best: dict[int, tuple[int, int, int]] = {}
        found = array.find(strings)
        for j in np.flatnonzero(found >= 0):
            i, total, path_part = owners[j]
            best[i] = max(best.get(i, (0, 0, -1)), (total, -path_part, int(found[j])))
        rules, verdicts = [], []
        for i in range(len(parts)):
            k = best[i][2] if i in best else -1
            text = array.blob[int(array.ends[k]):int(array.ends[k + 1])].tobytes().decode() if k >= 0 else None
            rules.append(spelt.get(text, text))
            verdicts.append(default if k < 0 else "block" if array.blocks[k] else "allow")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
             pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=[batch.schema.names[0], "host", "path", "rule", "verdict"])


def judge(urls: DataFrame, allow: Sequence[str], block: Sequence[str], id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row; one narrow pass over the table."""
    spark = urls.sparkSession
    ship(spark)
    spelt, blocks = {}, {}
    for rule, blocked in [*((r, False) for r in allow), *((r, True) for r in block)]:
        host, path = split_rule(rule)
        spelt.setdefault(host + path, rule)
        blocks[host + path] = blocks.get(host + path, False) or blocked
    lengths = sorted({len(r) - len(r.partition("/")[0]) for r in blocks})
    rows = urls.select(F.col(id_col), F.col(url_col).cast("string"))
    if sum(map(len, blocks)) > ARRAY_CHARS:
        return judge_by_join(rows, blocks, spelt, lengths, id_col, url_col, default)
    folder = tempfile.mkdtemp(prefix="courtload-rules-")   # the driver's file server sends it from here
    path = Path(folder, f"rules-{Path(folder).name}.bin")
    write_array(blocks, str(path))
    spark.sparkContext.addFile(str(path))
    name, changed = path.name, {k: v for k, v in spelt.items() if k != v}
    schema = T.StructType([T.StructField(id_col, field_type(urls, id_col)),
                           *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict"))])
    return rows.mapInArrow(lambda it: _judge_batches(it, name, lengths, changed, default), schema)


def judge_by_join(rows: DataFrame, blocks: dict[str, bool], spelt: dict[str, str], lengths: list[int],
                  id_col: str, url_col: str, default: str) -> DataFrame:
    """The way for rule sets too large to send whole: candidate strings joined with the rules."""
    spark = rows.sparkSession
    rules = spark.createDataFrame([(r, spelt[r], "block" if b else "allow") for r, b in blocks.items()],
                                  "`__key` string, rule string, verdict string")
    rest = F.regexp_extract("__url", r"(?s)^.*?://([^/?#]*)", 1)
    sized = F.array(*(F.lit(n) for n in lengths))
    keyed = (rows.select(F.struct(F.col(id_col)).alias("__id"), F.col(url_col).alias("__url"))
             .withColumn("__row", F.monotonically_increasing_id())
             .withColumn("host", F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                            F.lit("")))
             .withColumn("path", F.coalesce(F.regexp_extract("__url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = keyed.select("__row", F.explode(suffixes).alias("__host"), "path").select(
        "__row", "__host", F.explode(F.filter(sized, lambda n: n <= F.length("path"))).alias("__n"), "path").select(
        "__row", F.concat("__host", F.substring(F.col("path"), F.lit(1), F.col("__n"))).alias("__key"), F.length("__host").alias("__h"))
    best = probes.where(F.col("__h") > 0).join(rules, "__key").groupBy("__row").agg(
        F.max(F.struct(F.length("__key").alias("n"), "__h", "rule", "verdict")).alias("__best"))
    return keyed.join(best, "__row", "left").select(
        F.col(f"__id.{id_col}").alias(id_col), "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
