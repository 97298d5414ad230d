"""Byte-level BPE by content-defined chunk reuse.

A rolling hash over the UTF-8 bytes cuts each text at places that depend on the bytes near them
alone, so a passage shared by documents is cut alike in each.  Chunks are kept with their ids by
their whole bytes (a hash collision can't mix them up) and encoded once per worker: whole passages
by coarse chunks, and what is new in those by the fine chunks that the same hash gives with
fewer bits.

Chunk ids joined are not always the ids of the text.  A join is known to agree where the left chunk
ends in a visible character and the right one starts with a space and a visible character: the
tokenizer's pattern always starts a new piece there and looks no further back.  Every other join is
repaired: the texts around it are encoded together, in a window that grows until its piece limits
agree with those of both chunks, and the ids between these limits are replaced.

Moving every chunk through a shuffle to encode it once per corpus would cost more than the encoding
it saves, so reuse is per worker; the table of a worker is bounded and starts anew at the bound,
which changes no result.

Defined cases: null text counts as empty (no ids); repeated rows and null ids are rows like any
other; an empty table gives an empty result; other columns are not read, so none can clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from courtload.llm.common import field_type, ship
from courtload.llm.tokens import byte_char

#: Bits of the rolling hash that are zero at a cut: one in 2**CUT_BITS places is taken.
CUT_BITS = 7
#: Bytes without a place to cut after which a cut is made at the next character.
LONGEST = 1 << 16
#: Bytes of chunks and their ids kept per worker, besides those of the last text.
KEPT_BYTES = 48 << 20

# Fixed value: the split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Columns made from a batch's ids.
Outputs = Callable[["ChunkEncoder", list[bytes]], list[pa.Array]]

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes that end at each byte, by doubling the window."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def cut_places(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hash at each, whether the join there is known to agree).

    Places are those known to agree, and in runs of LONGEST bytes without one, forced ones.
    """
    b = np.frombuffer(data, np.uint8)
    if len(b) < 3:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint32), none.astype(bool)
    spaces = np.flatnonzero(b[1:-1] == 0x20) + 1
    lead, after = b[spaces - 1], b[spaces + 1]
    two = np.where(spaces > 1, b[spaces - 2], 0)
    places = spaces[(_VISIBLE[lead] | ((lead >= 0x80) & (two == 0xC3))) & (_VISIBLE[after] | (after == 0xC3))]
    known = np.ones(len(places), bool)
    limits = np.concatenate([[0], places, [len(b)]])
    wide = np.flatnonzero(np.diff(limits) > LONGEST)
    if len(wide):
        forced = []
        for k in wide:
            at, end = int(limits[k]), int(limits[k + 1])
            while end - at > LONGEST:
                at += LONGEST
                while at < end and b[at] & 0xC0 == 0x80:   # a cut starts a character
                    at += 1
                if at < end:
                    forced.append(at)
        places = np.concatenate([places, np.array(forced, np.int64)])
        known = np.concatenate([known, np.zeros(len(forced), bool)])
        order = np.argsort(places, kind="stable")
        places, known = places[order], known[order]
    return places, rolling_hash(b)[places - 1], known


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        spec = json.loads(Path(path).read_text())
        spec["truncation"] = spec["padding"] = None
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.marks = [t["content"] for t in spec["added_tokens"]]
        added = {t["id"] for t in spec["added_tokens"]}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
        #: The rule about known joins, and ids that rise in the order of the merges, hold for plain byte-level BPE.
        self.chunked = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                        and not spec.get("normalizer") and not spec.get("post_processor") and merged == sorted(merged)
                        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                           "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                    for t in spec["added_tokens"]))
        if self.chunked:
            byte_of = {byte_char(i): i for i in range(256)}
            self.bytes_of = {i: bytes(map(byte_of.__getitem__, t)) for t, i in model["vocab"].items() if i not in added}
            self.plain = tiktoken.Encoding("plain", pat_str=PATTERN, special_tokens={},
                                           mergeable_ranks={t: i for i, t in self.bytes_of.items()})
            self.bytes_of |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.kept: dict[bytes, bytes] = {}
        self.kept_bytes = self.encoded = self.asked = self.repaired = 0

    def _alone(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def chunk(self, data: bytes) -> bytes:
        """Ids of one chunk.  Where it holds no special string, merging by rank gives the tokenizer's ids:
        two neighbours that spell a vocabulary entry are the pair it was merged from."""
        self.encoded += 1
        text = data.decode()
        if any(m in text for m in self.marks):
            return self._alone([text])[0]
        return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def limits(self, text: str) -> list[int]:
        """Character positions where the pieces of a text start, special strings included."""
        out, at = [], 0
        while at < len(text):
            found = min(((i, m) for m in self.marks if (i := text.find(m, at)) >= 0), default=(len(text), ""))
            if found[0] > at:
                out += [at + a for _, (a, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text[at:found[0]])]
            if found[1]:
                out.append(found[0])
            at = found[0] + len(found[1])
        return out

    def join(self, left: str, left_ids: bytes, right: str, right_ids: bytes) -> bytes:
        """Ids of ``left + right`` from those of both, by re-encoding around the join until both sides agree."""
        self.repaired += 1
        longest = max(map(len, self.marks), default=0)
        width = 64 + longest
        while width < max(len(left), len(right)):
            a, b = left[-width:], right[:width]
            # the start of the window may cut a piece of the left text: agree only at limits that
            # the left text has itself, seen from a window twice as wide
            wider = left[-2 * width:]
            mine = {x - (len(wider) - len(a)) for x in self.limits(wider)} if len(wider) < len(left) else \
                {x - (len(left) - len(a)) for x in self.limits(left)}
            both, own = self.limits(a + b), set(self.limits(b))
            # a piece that ends well inside a chunk doesn't depend on what follows it
            first = next((x for x in both if x >= longest and x in mine and x <= len(a) - longest - 2), None)
            last = next((x for x in both if x >= len(a) + longest and x - len(a) in own and x <= len(a + b) - longest - 2), None)
            if first is not None and last is not None and self._settled(left, len(left) - len(a) + first):
                tail = len(self._alone([left[len(left) - len(a) + first:]])[0])
                head = len(self._alone([right[:last - len(a)]])[0])
                middle = self._alone([(a + b)[first:last]])[0]
                return left_ids[:len(left_ids) - tail] + middle + right_ids[head:]
            width *= 4
        return self._alone([left + right])[0]

    def _settled(self, text: str, at: int) -> bool:
        """Whether a piece starts here whatever came before: a space and a visible character after a visible one."""
        return (0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace()
                and not text[at + 1].isspace())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.chunked:
            return self._alone(texts)
        return [self._encode(t.encode()) for t in texts]

    def _encode(self, data: bytes) -> bytes:
        places, hashes, known = cut_places(data)
        taken = (hashes & np.uint32((1 << CUT_BITS) - 1) == 0) | ~known
        at = [0, *places[taken].tolist(), len(data)]
        chunks = [data[a:b] for a, b in zip(at, at[1:])] if data else []
        self.asked += len(chunks)
        if self.kept_bytes > KEPT_BYTES:
            self.kept.clear()
            self.kept_bytes = 0
        for c in chunks:
            if c not in self.kept:
                self.kept[c] = ids = self.chunk(c)
                self.kept_bytes += 170 + len(c) + len(ids)
        repair = [False, *(~known[taken]).tolist()]
        if not any(repair):
            return b"".join(map(self.kept.__getitem__, chunks))
        done, text, ids = [], "", b""   # ids of whole stretches between known joins; the open stretch
        for c, mend in zip(chunks, repair):
            if mend:
                ids = self.join(text, ids, s := c.decode(), self.kept[c])
                text += s
            else:
                done.append(ids)
                text, ids = c.decode(), self.kept[c]
        return b"".join([*done, ids])

    def decode(self, ids: list[bytes]) -> list[str]:
        """What the tokenizer's decode gives, special strings included."""
        if not self.chunked:
            return self.tokenizer.decode_batch([np.frombuffer(i, "<u4").tolist() for i in ids], skip_special_tokens=False)
        get = self.bytes_of.__getitem__
        return [b"".join(map(get, np.frombuffer(i, "<u4").tolist())).decode(errors="replace") for i in ids]


@functools.lru_cache(1)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process, kept between its tasks."""
    return ChunkEncoder(path)


def _batches(batches: Iterable[pa.RecordBatch], path: str, outputs: Outputs, names: list[str]) -> Iterator[pa.RecordBatch]:
    encoder = chunk_encoder(path)
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), *outputs(encoder, ids)], names=names)


def _run(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, fields: list[T.StructField],
         outputs: Outputs) -> DataFrame:
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), *fields])
    names = schema.names
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: _batches(it, tokenizer, outputs, names), schema)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row; ids as little-endian unsigned 32-bit integers in one binary value.

    ``tokenizer``: path of a tokenizers file on every machine.
    """
    return _run(docs, tokenizer, id_col, text_col, [T.StructField("ids", T.BinaryType())],
                lambda _, ids: [pa.array(ids, pa.binary())])


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: encoded, then decoded in the same pass."""
    return _run(docs, tokenizer, id_col, text_col,
                [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())],
                lambda e, ids: [pa.array(ids, pa.binary()), pa.array(e.decode(ids), pa.string())])


def _digest(encoder: ChunkEncoder, ids: list[bytes]) -> list[pa.Array]:
    listed = [",".join(map(str, np.frombuffer(i, "<u4").tolist())) for i in ids]
    return [pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in encoder.decode(ids)], pa.string())]


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the round trip's ids as decimals joined by commas, and its texts."""
    return _run(docs, tokenizer, id_col, text_col,
                [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                 T.StructField("decoded_sha256", T.StringType())], _digest)
