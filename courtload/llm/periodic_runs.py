"""Periodic runs of words by a dictionary of basic factors.

Words are the stretches of ``[^\\x20\\x09-\\x0D]`` of a text.  For each power of two L a position is named by
the first place in its text where the L words from there stand; the names of length 2L are made from pairs
of names of length L, by sorting.  Only positions whose factor comes again in the text go on to the next
length, so texts without repeats end after a few.

Occurrences of one factor less than 2L apart form arithmetic progressions: successors at most L/2 apart
follow each other at the factor's smallest period, and at most four such progressions start within 2L.  A
run of smallest period q, L <= q < 2L, starting at s has its factor at s and at s + q, and the latter is
the first of its progression (else one of the two progressions would go on into the other, and q would
not be the smallest period or s not the start).  So the distances in [L, 2L) from each position to the first places
of the progressions after it propose every period of every run.  Proposals are extended to both sides by the
names themselves, longest factors first, and of proposals that extend to the same stretch the
smallest period stays.

Every text is worked on by itself, in the scan's tasks and without a shuffle; memory is of the order of
n log n for the longest text and for a block of WORDS_AT_ONCE words.

Defined cases: null, empty and blank texts have no words and no runs; repeated rows, null and tied ids are
rows like any other; texts of any length are taken whole; an empty table gives an empty result; other
columns are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, returned, ship

#: A run has at least this many words, and at least twice its period.
LEAST = 12
#: Words of a block of texts that are worked on together; a longer text is a block of its own.
WORDS_AT_ONCE = 1 << 19

#: A change of a text's words before the search, given its id.
Change = Callable[[object, list[bytes]], list[bytes]]

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _groups(order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, number of its group) of the places whose key comes more than once, in the order given."""
    sorted_key = key[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = sorted_key[1:] == sorted_key[:-1]
    again = same[:-1] | same[1:]
    return order[again], np.cumsum(~same[:-1])[again]


def _proposals(place: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) to the first places of later progressions, at distances from length to below its double."""
    first = np.ones(len(place), bool)
    first[1:] = (group[1:] != group[:-1]) | ((place[1:] - place[:-1]) * 2 > length)
    heads = np.append(np.flatnonzero(first), len(place))
    after = heads[np.cumsum(first)]          # for each place, the next head in the list
    at, to, found = np.arange(len(place)), after, []
    while len(at):
        inside = to < len(place)
        at, to = at[inside], to[inside]
        away = place[to] - place[at]
        near = (group[to] == group[at]) & (away < 2 * length)
        at, to, away = at[near], to[near], away[near]
        far = away >= length
        found.append((place[at[far]], away[far]))
        to = after[to]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def _extend(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words before and from ``a`` and ``b`` on are the same; names tell for each length at once."""
    right, left = np.zeros_like(a), np.zeros_like(a)
    for k in range(len(names) - 1, -1, -1):
        name = names[k]
        right += (name[a + right] == name[b + right]).astype(np.int64) << k
        before = a - left - (1 << k)
        held = np.maximum(before, 0)
        left += ((before >= 0) & (name[held] == name[held + (b - a)])).astype(np.int64) << k
    return left, right


def runs(first: np.ndarray, end: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of the runs of some texts laid end to end, by start and period.

    ``first``: for each word the first place of the same word in its text; ``end``: where its text ends.
    """
    n = len(first)
    places = np.arange(n + 1)
    names = [np.append(first, n)]
    alike = np.flatnonzero(first[1:] == first[:-1])      # period 1
    found = [(alike, np.ones(len(alike), np.int64))]
    again = np.append(np.bincount(first, minlength=n)[first] > 1, False) if n else np.zeros(1, bool)
    length = 1
    while True:
        name = names[-1]
        at = np.flatnonzero(again[:-1])
        at = at[at + 2 * length <= end[at]]
        at = at[again[at + length]]
        key = name[at] * (n + 1) + name[at + length]
        kept, group = _groups(np.argsort(key, kind="stable"), key)
        if not len(kept):
            break
        length *= 2
        place = at[kept]
        head = np.ones(len(group), bool)
        head[1:] = group[1:] != group[:-1]
        longer = places.copy()
        longer[place] = place[head][np.cumsum(head) - 1]
        names.append(longer)
        again = np.zeros(n + 1, bool)
        again[place] = True
        found.append(_proposals(place, group, length))
    out = []
    for a, period in found:
        order = np.lexsort((a, period))
        a, period = a[order], period[order]
        new = np.ones(len(a), bool)     # neighbours on one diagonal extend to the same stretch
        new[1:] = (a[1:] != a[:-1] + 1) | (period[1:] != period[:-1])
        a, period = a[new], period[new]
        left, right = _extend(names, a, a + period)
        total = period + left + right
        long = (total >= least) & (total >= 2 * period)
        out.append(np.stack([(a - left)[long], total[long], period[long]], 1))
    every = np.concatenate(out)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _block(texts: list[list[bytes]], least: int) -> tuple[list[np.ndarray], list[str]]:
    """Runs of each text, and the texts without the repeats of their runs."""
    size = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(size) - size
    codes: list[int] = []
    for words, at in zip(texts, base.tolist()):
        codes.extend(map({}.setdefault, words, count(at)))
    found = runs(np.array(codes, np.int64), np.repeat(base + size, size), least)
    limits = np.searchsorted(found[:, 0], np.append(base, size.sum()))
    cover = np.zeros(size.sum() + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(cover)[:-1] > 0
    own, left = [], []
    for words, at, a, b in zip(texts, base.tolist(), limits.tolist(), limits[1:].tolist()):
        if b > a:
            words = [words[k] for k in np.flatnonzero(~dropped[at:at + len(words)]).tolist()]
        own.append(found[a:b] - [at, 0, 0])
        left.append(b" ".join(words))
    return own, left


def _run_batches(batches: Iterable[pa.RecordBatch], names: list[str], least: int,
                 change: Change | None) -> Iterator[pa.RecordBatch]:
    def block(rows: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        own, left = _block(texts, least)
        flat = np.concatenate([np.zeros((0, 3), np.int64), *own])
        listed = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum([len(r) for r in own])), pa.int32()),
            pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.names))
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(t) for t in texts], pa.int64()), listed,
                                           pa.array(left, pa.binary()).cast(pa.string())], names=names)

    for batch in batches:
        held, at, n = [], 0, 0
        for row in range(batch.num_rows):
            words = (batch.column(1)[row].as_py() or "").encode().split()
            if change:
                words = change(batch.column(0)[row].as_py(), words)
            if held and n + len(words) > WORDS_AT_ONCE:
                yield block(batch.slice(at, len(held)), held)
                held, at, n = [], row, 0
            held.append(words)
            n += len(words)
        if held:
            yield block(batch.slice(at), held)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
         change: Change | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    ``runs``: (start, length, period) in words, by start and period.  ``collapsed``: the words that no run holds after
    its first period, joined by single spaces.  ``change`` may give other words for an id and its words.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    names = schema.names
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_run_batches(it, names, least, change)), schema)


def longest(runs_col: str = "runs") -> Column:
    """The longest run of a list of runs (ties: smallest start, then period) as a struct; null without runs."""
    ranked = F.array_max(F.transform(runs_col, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(ranked.isNotNull(), F.struct(
        (-ranked["s"]).alias("start"), ranked["length"].alias("length"), (-ranked["p"]).alias("period")))
