"""Language models and Hilbert shards against plain versions, and how many shards a filter on a dimension spares."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from courtload.llm import hilbert, lang_id
from courtload.llm.common import table
from tests.conftest import SF_MID
from tests.llm.helpers import docs, prose


class PlainKneserNey:
    """One language's model by the definition, in dictionaries."""

    def __init__(self, grams, alphabet):
        self.alphabet, self.counts = alphabet, {len(next(iter(grams))): Counter(grams)}
        for order in range(len(next(iter(grams))) - 1, 0, -1):      # how many characters come before a gram
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.discount = {}
        for order, c in self.counts.items():
            ones, twos = (sum(n == k for n in c.values()) for k in (1, 2))
            self.discount[order] = ones / (ones + 2 * twos) if ones else 0.5

    def p(self, text):
        if not text:
            return 1 / self.alphabet
        counts, d = self.counts[len(text)], self.discount[len(text)]
        followers = [n for g, n in counts.items() if g[:-1] == text[:-1]]
        lower = self.p(text[1:])
        if not followers:
            return lower
        return (max(counts[text] - d, 0) + d * len(followers) * lower) / sum(followers)


def test_scores_are_those_of_the_definition():
    rng = random.Random(5)
    grams = {name: Counter() for name in ("aa", "bb", "cc")}
    for name, letters in zip(grams, ("abcd", "bcdé", "xyab")):
        text = "   " + "".join(rng.choice(letters + " ") for _ in range(300))
        grams[name].update(text[i:i + 4] for i in range(len(text) - 3))
    rows = [(k, [ord(x) for x in g], n) for k, c in enumerate(grams.values()) for g, n in c.items()]
    model = lang_id.build(list(grams), np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    alphabet = len({x for c in grams.values() for g in c for x in g}) + 1
    plain = [PlainKneserNey(c, alphabet) for c in grams.values()]
    asked = ["".join(rng.choice("abcdéxyz 中") for _ in range(4)) for _ in range(400)] + [g for c in grams.values() for g in c]
    chars = np.array([[ord(x) for x in g] for g in asked], np.uint64)
    got = model.score(chars.ravel(), np.arange(len(asked)) * 4 + 3)
    want = [[math.log(m.p(g)) for m in plain] for g in asked]
    assert np.allclose(got, want, atol=2e-4)


def plain_place(point, bits):
    """Skilling's transform, step by step."""
    x, n = list(point), len(point)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            if x[i] >> b & 1:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0], x[i] = x[0] ^ t, x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            t ^= (1 << b) - 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def plain_steps(values, bits):
    known = sorted(v for v in values if v is not None)
    limits = {known[max(math.ceil(k / (1 << bits) * len(known)), 1) - 1] for k in range(1, 1 << bits)} if known else set()
    return [0 if v is None else sum(x < v for x in limits) * ((1 << bits) - 1) // max(len(limits), 1) for v in values]


def plain_shards(rows, dims, count):
    steps = list(zip(*(plain_steps([r[d] for r in rows], hilbert.BITS) for d in dims)))
    data = [(r["text"] or "").encode() for r in rows]
    keys = [(plain_place(s, hilbert.BITS), zlib.crc32(t), len(t) + 16, r["doc_id"] is not None, r["doc_id"] or 0) for r, s, t in zip(rows, steps, data)]
    out, filled = [], Counter()
    for rank, (_, crc, size, _, doc) in enumerate(sorted(keys)):
        shard = rank * count // len(rows)
        out.append((doc, size, crc, shard, filled[shard]))
        filled[shard] += 1
    return sorted(out)


def test_shards_are_those_of_a_plain_sort(spark, tmp_path):
    rng = random.Random(2)
    texts = [(None if k == 7 else k, None if k % 50 == 3 else prose(k % 90, rng.randint(0, 40)), rng.choice(["de", "en", "fr", None, "dé"]))
             for k in range(600)] + [(1, "same", "de")] * 5
    made = docs(spark, tmp_path / "d", texts, 3)
    dims = ["lang", "source", "n_chars"]
    got = hilbert.shards(made, dims).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32, r.shard, r.slot) for r in got) == plain_shards([r.asDict() for r in made.collect()], dims, 40)


def test_filters_on_each_dimension_spare_shards(spark):
    """Shards whose lowest and highest value tell that a filter finds nothing in them, against shards by a hash of the id."""
    made = table(spark, SF_MID, "documents")
    dims = ["lang", "source", "n_chars"]
    place = hilbert.shards(made, dims).select("doc_id", "shard")
    tenth = made.agg(F.percentile_approx("n_chars", 0.1)).first()[0]
    some = {d: made.groupBy(d).count().where(F.col(d).isNotNull()).orderBy("count", d).first()[d] for d in dims[:2]}
    hashed = made.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(40)).alias("shard"))

    def spared(shards):
        ends = made.join(shards, "doc_id").groupBy("shard").agg(*(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("low", F.min), ("high", F.max))))
        kept = {**{d: F.coalesce((F.col(f"low_{d}") <= v) & (F.col(f"high_{d}") >= v), F.lit(False)) for d, v in some.items()},
                "n_chars": F.col("low_n_chars") <= tenth}
        return ends.agg(*(F.count_if(~c).alias(d) for d, c in kept.items())).first().asDict()
    curve, by_hash = spared(place), spared(hashed)
    print("shards of 40 spared by a filter:", curve, "by a hash of the id:", by_hash)
    assert all(curve[d] >= 10 and curve[d] > by_hash[d] for d in dims)
