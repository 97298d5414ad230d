"""Deterministic sharded WARC archives of pages, and reading them back.

Records are cut into shards, ranges of page id and digest, and written in that order: one gzip member per record,
headers and digests made anew from the payload, a new file whenever a shard's compressed size passes ``ROLL_BYTES``.
The shards' borders follow from the data alone: page keys chosen by a hash, about ``PER_SHARD`` for each shard, are
sorted and cut where their bytes are even.  Ids, dates and compression depend on the record.  So the same pages give
the same files, whatever the cluster, its splits and its partitions.  There is a shard for each ``SHARD_BYTES`` of
payload, ``MOST_SHARDS`` at most, larger ones beyond; so the keys that the driver sorts are bounded.

A task writes whole shards, under a name of its own attempt, and renames each finished file; the manifest of all files is
written by the same job and takes its final name last, so readers see whole archives or none, and a task that runs again
replaces its files.

Of records with equal payloads (same SHA-256 and length) of at least ``SMALLEST`` bytes, the one with the
smallest id is the response and the others revisit it.  Texts go through one shuffle: what is to be
revisited joins their sort as short rows of its own, which come just before their page.

Files go through pyarrow.fs to the given folder, which all executors share (any scheme it knows).

Defined cases: null html is an empty payload; null ids sort first and refer like any other (of a group
whose ids are all null, the first by URL is the response); rows that repeat an id and payload: one response,
the others revisit it; a null URL gives no target header, control characters in URLs are percent-encoded;
an empty table gives no file and no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from math import ceil
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, materialize, ship

ROLL_BYTES = 64 << 20
SMALLEST = 100
SHARD_BYTES = 4 << 20
MOST_SHARDS = 10_000
PER_SHARD = 20
LEVEL = 6
DATE = "2020-01-01T00:00:00Z"
_LINE = b"\r\n"

# The header names and the profile of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

MANIFEST = "file string, records long, bytes long, sha256 string, first string, last string"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def record_id(page: object, digest: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page, digest, number]))}>"


def member(headers: list[tuple[str, str]], block: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + 2 * _LINE) + z.flush()


def page_record(page: object, url: str | None, payload: bytes, digest: str, number: int, first: object, revisit: bool,
                date: str = DATE, level: int = LEVEL) -> bytes:
    http = HTTP_HEAD.format(len(payload)).encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, digest, number)),
               ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", json.dumps(page)),
               ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c >= " " and c != "\x7f" else quote(c) for c in url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, digest, 0)), ("X-Refers-To-Page", json.dumps(first))]
    return member(headers, http if revisit else http + payload, level)


class Roller:
    """Files of one shard: written under a temporary name, renamed when full."""

    def __init__(self, fs: pafs.FileSystem, root: str, part: int, attempt: int, roll: int) -> None:
        self.fs, self.root = fs, root
        self.part, self.attempt, self.roll, self.number = part, attempt, roll, 0
        self.out = None

    def add(self, data: bytes, page: object) -> dict | None:
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.attempt}-{self.name}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.sha, self.size, self.records, self.first = hashlib.sha256(), 0, 0, json.dumps(page)
            self._put(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(self.name, "", 0)), ("WARC-Date", DATE),
                              ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")],
                             b"format: WARC File Format 1.1\r\n"))
        self._put(data)
        self.records += 1
        self.last = json.dumps(page)
        return self.close() if self.size >= self.roll else None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temporary, f"{self.root}/{self.name}")
        self.out = None
        self.number += 1
        return {"file": self.name, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest(),
                "first": self.first, "last": self.last}


def _write_batches(batches: Iterable[pa.RecordBatch], folder: str, roll: int, date: str, level: int,
                   schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    fs, root = open_folder(folder)
    files = None
    group, marked, first, number = None, False, None, 0
    for batch in batches:
        done = []
        for shard, page, digest, kind, refers, url, html in zip(*(c.to_pylist() for c in batch.columns)):
            if files is None or files.part != shard:
                if files is not None:
                    done.append(files.close())
                files = Roller(fs, root, shard, task.taskAttemptId(), roll)
            if group != (page, digest):
                group, marked, first, number = (page, digest), False, None, 0
            if kind == 0:   # this page and payload belong to a group of copies
                marked, first = True, refers
                continue
            revisit = marked and (first != page or number > 0)
            done.append(files.add(page_record(page, url, (html or "").encode(), digest, number, first, revisit, date, level), page))
            number += 1
        done = [d for d in done if d]
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if files is not None and (d := files.close()) is not None:
        yield pa.RecordBatch.from_pylist([d], schema)


Key = tuple[bool, object, str]


def _key(page: object, digest: str) -> Key:
    """Keys in Spark's order: null ids first."""
    return (False, 0, digest) if page is None else (True, page, digest)


def borders(keys: DataFrame) -> list[Key]:
    """The first keys of all shards but the first, from the table of keys (page, digest, n, size) alone."""
    total = keys.agg(F.count("*").alias("keys"), F.sum(F.col("n") * F.col("size")).alias("bytes")).first()
    shards = min(MOST_SHARDS, ceil((total["bytes"] or 0) / SHARD_BYTES))
    if shards < 2:
        return []
    share = F.lit(min(1.0, shards * PER_SHARD / total["keys"]) * (1 << 32))
    some = keys.where(F.pmod(F.xxhash64("page", "digest"), F.lit(1 << 32)) < share)   # about MOST_SHARDS * PER_SHARD rows at most
    chosen = sorted((_key(r["page"], r["digest"]), r["n"] * (r["size"] + 500)) for r in some.select("page", "digest", "n", "size").collect())
    step, passed, out = sum(b for _, b in chosen) / shards, 0, []
    for key, size in chosen:
        if passed >= step * (len(out) + 1):
            out.append(key)
        passed += size
    return out


def _shard_of(found: list[Key]):
    """The shard of a key, as a column function."""
    @F.arrow_udf("int")
    def shard(page: pa.Array, digest: pa.Array) -> pa.Array:
        return pa.array([bisect_right(found, k) for k in map(_key, page.to_pylist(), digest.to_pylist())], pa.int32())
    return shard


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          roll: int = ROLL_BYTES, date: str = DATE, level: int = LEVEL) -> None:
    """Write an archive of all pages into a new folder; its manifest is there once it is whole."""
    spark = pages.sparkSession
    ship(spark)
    data = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    page = F.col(id_col).alias("page")
    keys = materialize(pages.select(page, F.sha2(data, 256).alias("digest"), F.octet_length(data).alias("size"))
                       .groupBy("page", "digest", "size").agg(F.count("*").alias("n")), "page-keys")
    large = keys.where(F.col("size") >= SMALLEST)
    copies = materialize(large.groupBy("digest").agg(F.sum("n").alias("n"), F.min("page").alias("refers"))
                         .where("n > 1").select("digest", "refers"), "page-copies")
    marks = large.select("page", "digest").join(copies, "digest").select(
        "page", "digest", F.lit(0).alias("kind"), "refers", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"))
    rows = pages.select(page, F.sha2(data, 256).alias("digest"), F.lit(1).alias("kind"),
                        F.lit(None).cast(field_type(pages, id_col)).alias("refers"),
                        F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = pa.schema([(n, pa.string() if n in ("file", "sha256", "first", "last") else pa.int64())
                        for n in ("file", "records", "bytes", "sha256", "first", "last")])
    found = borders(keys)
    shard = _shard_of(found)("page", "digest") if found else F.lit(0)
    order = ["shard", "page", "digest", "kind", "url"]
    manifest = (rows.unionByName(marks).select(shard.alias("shard"), "*").repartitionById(len(found) + 1, F.col("shard")).sortWithinPartitions(*order)
                .mapInArrow(lambda it: _write_batches(it, folder, roll, date, level, schema), MANIFEST))
    manifest.write.json(f"{folder}/_manifest.tmp")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(conf)
    if not store.rename(path(f"{folder}/_manifest.tmp"), path(f"{folder}/_manifest")):
        raise OSError(f"{folder}: the manifest can't take its name")
    store.delete(path(f"{folder}/_temporary"), True)


def members(stream: object, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, parts = zlib.decompressobj(31), []
    data = stream.read(size)
    while data:
        parts.append(z.decompress(data))
        data = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
        if not data:
            data = stream.read(size)
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(2 * _LINE)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != 2 * _LINE:
        raise ValueError("a record's length is wrong")
    return headers, block


def _read_batches(batches: Iterable[pa.RecordBatch], folder: str, schema: pa.Schema, payloads: bool) -> Iterator[pa.RecordBatch]:
    store, root = open_folder(folder)
    for batch in batches:
        for name in batch.column(0).to_pylist():
            out, held = [], 0
            with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for record in members(stream):
                    headers, block = parse(record)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    payload, digest = block.partition(2 * _LINE)[2], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    whole = headers["WARC-Type"] == "response"
                    if whole and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: a payload's digest is wrong")
                    out.append({"page": json.loads(headers["X-Page-Id"]), "url": headers.get("WARC-Target-URI"),
                                "record_type": headers["WARC-Type"], "payload_digest": digest,
                                "payload_bytes": len(payload) if whole else int(headers["X-Payload-Length"]),
                                "refers_to": json.loads(headers.get("X-Refers-To-Page", "null")),
                                "payload": payload if payloads and whole else None})
                    held += len(payload) * payloads + 500
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)


def read(spark: SparkSession, folder: str, id_type: T.DataType, payloads: bool = True) -> DataFrame:
    """(page, url, record_type, payload_digest, payload_bytes, refers_to, payload) of an archive's records.

    Payloads are checked against their digests.  They are null for revisits, and for all without ``payloads``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    ship(spark)
    schema = T.StructType([T.StructField("page", id_type), T.StructField("url", T.StringType()),
                           T.StructField("record_type", T.StringType()), T.StructField("payload_digest", T.StringType()),
                           T.StructField("payload_bytes", T.LongType()), T.StructField("refers_to", id_type),
                           T.StructField("payload", T.BinaryType())])
    files = spark.read.schema(MANIFEST).json(f"{folder}/_manifest").select("file")
    arrow = to_arrow_schema(schema)
    tasks = max(1, min(files.count(), 10_000))   # a task per file
    return files.repartition(tasks, "file").mapInArrow(lambda it: _read_batches(it, folder, arrow, payloads), schema)
