"""Secrets in texts, by one combined deterministic automaton.

The expressions of all rules are compiled into one automaton (``automata``: subset construction,
minimisation, a transition array) that reads texts from their end, so that an accepting state at a byte says which
rules have a match that starts there.  All rules are scanned in that one pass.  Texts are cut into
lanes where a byte leads from every state to the start (a line end, most punctuation), and the lanes of a
batch take one step at a time together, as one array operation.

From the starts, the matches of each rule are taken from left to right: the longest one from the first start, then
from the first start at or after its end.  That is what a backtracking search finds for these rules, as none
of them has two ways to read a text.  A match is kept if ``whole`` fits all of it: so a rule can take a
stretch up and still refuse it.

Every text is scanned whole and by itself, without a shuffle.

Defined cases: null and empty texts have no spans; places are code points, also in texts with other characters;
repeated rows, null and tied ids are rows like any other; an empty table gives an empty result; other
columns are not read, so none can clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.automata import Automaton, compile_all
from courtload.llm.common import field_type, returned, ship


class Rule(NamedTuple):
    kind: str
    #: What a match takes up.
    taken: str
    #: What all of a match must fit to be kept.
    whole: str


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""

BASE = (
    Rule("assign", _ASSIGN + "+", _ASSIGN + "{12,}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14,}"),
    # a stretch of such digits is one match whatever its length, so short ones needn't be taken up
    Rule("hex", "[0-9a-f]{16,}", "[0-9a-f]{16,}"),
)
# The public formats of some issuers' keys.
ISSUED = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[opsru]_[A-Za-z0-9]+", "gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", "[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE + ISSUED

#: Bytes of a lane, up to the next byte that leads to the start.
LANE = 2048
#: Lanes left at which each is read to its end by itself.
FEW = 24
#: Bytes of texts scanned together; a longer text is scanned alone.
TOGETHER = 1 << 24

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])


@functools.lru_cache(2)
def scanner(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    """The automaton of all rules for texts read from their end, and each rule's own for what is taken and kept."""
    return (compile_all([r.taken for r in rules], backward=True, anywhere=True),
            [compile_all([r.taken, r.whole]) for r in rules])


def starts(auto: Automaton, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, bits of the rules) where matches start, of texts laid end to end that end at ``ends``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    calm = np.append(np.flatnonzero(auto.resets[data]), len(data))
    cuts = calm[np.searchsorted(calm, np.arange(LANE, len(data), LANE))]
    limits = np.unique(np.concatenate([[0], ends, cuts, [len(data)]]))
    low, high = limits[:-1], limits[1:]
    size = high - low
    order = np.argsort(-size, kind="stable")
    low, high, size = low[order], high[order], size[order]
    open_lanes = np.searchsorted(-size, -np.arange(size[0]), side="left")   # lanes longer than each step's number
    state = np.full(len(high), auto.start * 256, np.int32)
    at, limit, step = high.copy(), auto.accepting * 256, auto.step
    found, masks = [], []
    for m in open_lanes[open_lanes > FEW].tolist():
        at = at[:m] - 1
        state = step[state[:m] + data[at]]
        hit = np.flatnonzero(state >= limit)
        if len(hit):
            found.append(at[hit])
            masks.append(auto.accepts[state[hit] >> 8])
    rest, rows = np.flatnonzero(size > len(open_lanes[open_lanes > FEW])), auto.rows
    for lane in rest.tolist():
        one, hits, last, first = int(state[lane]), [], int(at[lane]), int(low[lane])
        for k, byte in enumerate(reversed(data[first:last].tobytes()), 1):
            one = rows[one + byte]
            if one >= limit:
                hits.append((last - k, one >> 8))
        if hits:
            where, states = np.array(hits).T
            found.append(where)
            masks.append(auto.accepts[states])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, mask = np.concatenate(found), np.concatenate(masks)
    order = np.argsort(place)
    return place[order], mask[order]


def spans(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) of each text's matches in code points, in order."""
    auto, own = scanner(rules)
    coded = [t.encode() for t in texts]
    ends = np.cumsum([len(c) for c in coded])
    whole = b"".join(coded)
    data = np.frombuffer(whole, np.uint8)
    place, mask = starts(auto, data, ends)
    limits = np.searchsorted(place, np.append(0, ends)).tolist()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (a, b) in enumerate(zip(limits, limits[1:])):
        if a == b:
            continue
        base, end = int(ends[k]) - len(coded[k]), int(ends[k])
        found = []
        for r, one in enumerate(own):
            mine = place[a:b][mask[a:b] >> r & 1 == 1]
            i = 0
            while i < len(mine):
                s = int(mine[i])
                taken, fits = one.longest(whole, s, end)
                if taken == fits:
                    found.append((s - base, r, taken - base))
                i = max(i + 1, int(np.searchsorted(mine, taken)))
        if found and len(texts[k]) != len(coded[k]):
            chars = np.append(0, np.cumsum((data[base:end] & 0xC0) != 0x80))
            found = [(int(chars[s]), r, int(chars[e])) for s, r, e in found]
        out[k] = sorted(found)
    return out


def _scan_batches(batches: Iterable[pa.RecordBatch], names: list[str], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    kinds = [r.kind for r in rules]

    def block(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        found = spans(texts, rules)
        flat = [s for of in found for s in of]
        listed = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum([len(f) for f in found])), pa.int32()),
            pa.StructArray.from_arrays([pa.array([kinds[r] for _, r, _ in flat], pa.string()),
                                        pa.array([s for s, _, _ in flat], pa.int64()),
                                        pa.array([e for _, _, e in flat], pa.int64())], names=SPAN.names))
        return pa.RecordBatch.from_arrays([rows.column(0), listed], names=names)

    for batch in batches:
        held, at, n = [], 0, 0
        for row in range(batch.num_rows):
            text = batch.column(1)[row].as_py() or ""
            if held and n + len(text) > TOGETHER:
                yield block(batch.slice(at, len(held)), held)
                held, at, n = [], row, 0
            held.append(text)
            n += len(text)
        if held:
            yield block(batch.slice(at), held)


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row; spans are (kind, start, end) in code points, by start and then rule."""
    ship(docs.sparkSession)
    scanner(rules)   # refuses unsupported rules before any task runs
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("spans", T.ArrayType(SPAN))])
    names = schema.names
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_scan_batches(it, names, rules)), schema)
