"""Language identification by interpolated Kneser-Ney character models.

One model of four-character grams per language, all kept in the same sorted arrays of 64-bit gram
hashes with a row of log-probabilities (a value per language): positions of a text are looked up by
binary search, the highest order first, and lower orders with the context's back-off weight where a
gram is new.  A text gets the language of the lowest cross-entropy per character.  Letters are
lower-cased and every run of other characters counts as one space.

The score is the share of the chosen language in a softmax of the length-normalised entropies, with the
sharpness that gives held-back rows of the sample their highest likelihood.  A text is rejected if it
has no letter, or if its entropy lies above what held-back rows of its language show, by
``REJECT_SD`` standard errors for its length plus ``REJECT_SLACK`` nats.

The classifier is fitted on a bounded sample of labelled rows: about ``DOCS_PER_LANG`` rows of each
language, chosen by a hash of their id, and of longer texts a piece of ``SAMPLE_CHARS`` characters.  That bounds
the grams that reach the driver and the broadcast model.  Predictions read every row and whole texts,
and nothing but the text.

Defined cases: null text or none with a letter: ``und``, score 0, rejected; without any labelled row
every text is ``und``; ties go to the language first in order; null and repeated ids are rows like any
other; an empty table gives an empty result.  ``predict`` returns only the id and its own columns,
``keep`` the columns of its input, whatever their names.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, materialize, returned, ship

ORDER = 4
DOCS_PER_LANG = 300
SAMPLE_CHARS = 20_000
REJECT_SD, REJECT_SLACK = 8.0, 1.0
#: Characters scored at once.
_PIECE = 1 << 18
_A = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(characters, text of each, whether it counts, letters per text) of texts in a row.

    Each text starts with three spaces that don't count themselves.
    """
    joined = "".join("\0\1\1" + (t.replace("\0", " ").replace("\1", " ") if "\0" in t or "\1" in t else t) for t in texts)
    a = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter, pad = _letters()[a], a <= 1
    owner = np.cumsum(a == 0) - 1
    kept = letter | pad
    kept[1:] |= ~kept[1:] & letter[:-1]   # the first of a run of others
    chars = np.where(letter, a, 32)[kept].astype(np.uint64)
    return chars, owner[kept], ~pad[kept], np.bincount(owner[letter], minlength=len(texts))


def hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position (from position order - 1 on)."""
    n = len(chars) - order + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(order):
        h = h * _A + chars[k:k + n]
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    langs: list[str]
    #: By order from 1: sorted gram hashes, and log-probabilities by language.
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    #: By context length from 1: sorted hashes, and log back-off weights by language.
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray
    sharpness: float = 1.0
    mean: np.ndarray | None = None
    sd: np.ndarray | None = None

    def score(self, chars: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability by language of the characters at these positions, each with three before it."""
        out = np.zeros((len(at), len(self.langs)), np.float32)
        left = np.arange(len(at))
        h = {k: hashes(chars, k) for k in range(1, ORDER + 1)}
        for order in range(ORDER, 0, -1):
            here = at[left]
            row, hit = _find(self.keys[order - 1], h[order][here - order + 1])
            out[left[hit]] += self.logp[order - 1][row[hit]]
            left, here = left[~hit], here[~hit]
            if not len(left):
                return out
            if order == 1:
                out[left] += self.floor
            else:
                row, hit = _find(self.contexts[order - 2], h[order - 1][here - order + 1])
                out[left[hit]] += self.weights[order - 2][row[hit]]
        return out

    def entropies(self, texts: list[str], squares: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy per character by text and language, characters, letters, mean squares) of whole texts."""
        size = np.array([len(t) for t in texts])
        total = np.zeros((len(texts), len(self.langs)))
        square = np.zeros_like(total) if squares else total
        count, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        start = 0
        while start < len(texts):
            end = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), _PIECE)))
            chars, owner, counts, letters[start:end] = characters(texts[start:end])
            for a in range(0, len(chars), _PIECE):   # a very long text in pieces, each with the three characters before it
                low = max(a - ORDER + 1, 0)
                part, mine = chars[low:a + _PIECE], owner[a:a + _PIECE]
                at = np.flatnonzero(counts[a:a + _PIECE])
                if not len(at):
                    continue
                got, mine = self.score(part, at + (a - low)), mine[at]
                firsts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                total[start + mine[firsts]] += np.add.reduceat(got, firsts, axis=0, dtype=np.float64)
                count[start:end] += np.bincount(mine, minlength=end - start)
                if squares:
                    square[start + mine[firsts]] += np.add.reduceat(got.astype(np.float64) ** 2, firsts, axis=0)
            start = end
        n = np.maximum(count, 1)[:, None]
        return -total / n, count, letters, square / n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        entropy, count, letters, _ = self.entropies([t or "" for t in texts])
        best = entropy.argmin(1)
        low = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - low[:, None])).sum(1)
        limit = self.mean[best] + REJECT_SD * self.sd[best] / np.sqrt(np.maximum(count, 1)) + REJECT_SLACK
        none = letters == 0
        names = ["und" if u else self.langs[b] for u, b in zip(none, best)]
        return names, np.where(none, 0.0, score), none | (low > limit)


def build(langs: list[str], lang: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Model:
    """Model from counts of grams: language number, characters (rows of ORDER) and count of each."""
    size = len(langs)
    keys, logp, contexts, weights = [], [], [], []
    alphabet = len(np.unique(grams)) + 1
    floor = np.full(size, -np.log(alphabet), np.float32)
    types = {ORDER: (lang, grams, counts.astype(np.float64))}
    for order in range(ORDER - 1, 0, -1):   # lower orders count the different characters before a gram
        above_lang, above, _ = types[order + 1]
        rows = np.column_stack([above_lang, above[:, 1:]])
        found, n = np.unique(rows, axis=0, return_counts=True)
        types[order] = (found[:, 0], found[:, 1:], n.astype(np.float64))
    lower_keys = lower = None
    for order in range(1, ORDER + 1):
        which, chars, n = types[order]
        grams_here, at = np.unique(chars, axis=0, return_inverse=True)
        at = at.ravel()
        h = hashes(grams_here.astype(np.uint64).ravel(), order)[::order]
        by_hash = np.argsort(h, kind="stable")
        place = np.empty_like(by_hash)
        place[by_hash] = np.arange(len(by_hash))
        here = np.zeros((len(h), size))
        here[place[at], which] = n
        ordered = grams_here[by_hash].astype(np.uint64)
        ones, twos = [(here == k).sum(0) for k in (1, 2)]
        discount = np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        discount = np.where(discount > 0, discount, 0.5)
        if order == 1:
            total, kinds = here.sum(0), (here > 0).sum(0)
            back = discount * kinds / np.maximum(total, 1)
            p = np.maximum(here - discount, 0) / np.maximum(total, 1) + back / alphabet
            floor = np.log(back / alphabet + 1e-12).astype(np.float32)
        else:
            context = hashes(np.ascontiguousarray(ordered[:, :-1]).ravel(), order - 1)[::order - 1]
            known, group = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((len(known), size)), np.zeros((len(known), size))
            np.add.at(total, group, here)
            np.add.at(kinds, group, here > 0)
            back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            suffix = hashes(np.ascontiguousarray(ordered[:, 1:]).ravel(), order - 1)[::order - 1]
            row, hit = _find(lower_keys, suffix)
            assert hit.all()
            p = np.maximum(here - discount, 0) / np.maximum(total, 1)[group] + back[group] * lower[row]
            contexts.append(known)
            weights.append(np.log(back).astype(np.float32))
        keys.append(h[by_hash])
        logp.append(np.log(p).astype(np.float32))
        lower_keys, lower = keys[-1], p
    return Model(langs, keys, logp, contexts, weights, floor)


def _gram_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for name in sorted(set(langs)):
            chars, _, counts, _ = characters([t for t, x in zip(texts, langs) if x == name])
            at = np.flatnonzero(counts)
            rows = np.column_stack([chars[at - k] for k in range(ORDER - 1, -1, -1)]).astype("<u4")
            found, n = np.unique(rows, axis=0, return_counts=True)
            grams = [r.tobytes().decode("utf-32-le", "surrogatepass") for r in found]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.string()),
                                              pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        docs_per_lang: int = DOCS_PER_LANG) -> Model | None:
    """Model of labelled rows (null languages are left out); None if there are none.  One pass over the table."""
    ship(labelled.sparkSession)
    labelled = labelled.where(F.col(lang_col).isNotNull())
    have = {str(r["lang"]): r["n"] for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not have:
        return None
    # twice the rows: odd keys train, even keys calibrate
    share = F.create_map(*(F.lit(x) for name in sorted(have) for x in (name, min(1.0, 2 * docs_per_lang / have[name]))))
    place = F.pmod(F.shiftrightunsigned("key", 20), F.lit(1_000_000)) / 1_000_000
    # rows without a key go by their text; rows that share a key count once, so that the sample stays bounded
    key = F.when(F.col(key_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(key_col))
    start = F.pmod("key", F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    sample = materialize(
        labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), key.alias("key"))
        .where(place < share[F.col("lang")])
        .withColumn("text", F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)))   # a piece of a longer text
        .where(F.col("text").rlike(r"\p{L}")).groupBy("lang", "key").agg(F.min("text").alias("text")),
        "language-sample")
    parts = [(r["lang"], r["odd"]) for r in sample.groupBy("lang", (F.col("key") % 2 != 0).alias("odd")).count().collect()]
    langs = sorted({x for x, _ in parts})
    if not langs:
        return None
    train = sample.where(F.col("key") % 2 != 0)
    if any((x, True) not in parts for x in langs):   # too few rows to hold some back
        train = sample
    found = (train.select("lang", "text").mapInArrow(_gram_batches, "lang string, gram string, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    chars = np.frombuffer("".join(found["gram"]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, ORDER)
    model = build(langs, found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64),
                  chars.astype(np.int64), found["n"].to_numpy())
    held = sample.where(F.col("key") % 2 == 0).select("lang", "text")
    return calibrate(model, (held if train is not sample else sample.select("lang", "text")))


def _entropy_batches(batches: Iterable[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entropy, count, _, square = model.value.entropies(batch.column(1).to_pylist(), squares=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(list(entropy), pa.list_(pa.float64())), pa.array(list(square), pa.list_(pa.float64())),
             pa.array(count, pa.int64())], names=["lang", "entropy", "square", "n"])


def calibrate(model: Model, held: DataFrame) -> Model:
    """Sharpness of the score, and mean and spread of a character's log-probability, from a bounded labelled sample."""
    sent = held.sparkSession.sparkContext.broadcast(model)
    got = held.mapInArrow(lambda it: _entropy_batches(it, sent),
                          "lang string, entropy array<double>, square array<double>, n long").toPandas()
    size = len(model.langs)
    model.mean, model.sd = np.full(size, np.log(len(model.keys[0]) + 1)), np.ones(size)
    if not len(got):
        return model
    entropy, square = np.stack(got["entropy"]), np.stack(got["square"])
    label = got["lang"].map({x: i for i, x in enumerate(model.langs)}).to_numpy()
    for i in range(size):
        if (mine := label == i).any():
            n = got["n"].to_numpy()[mine]
            model.mean[i] = np.average(entropy[mine, i], weights=n)
            model.sd[i] = max(np.sqrt(max(np.average(square[mine, i], weights=n) - model.mean[i] ** 2, 0)), 0.1)
    gap = entropy - entropy[np.arange(len(label)), label][:, None]
    tried = np.geomspace(0.5, 200, 40)
    # a held-back row that another language fits better keeps the sharpness finite
    loss = [np.log(np.exp(np.minimum(-t * gap, 500)).sum(1)).mean() + 1e-4 * t for t in tried]
    model.sharpness = float(tried[int(np.argmin(loss))])
    return model


def _predict_batches(batches: Iterable[pa.RecordBatch], model: object, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            lang, score, rejected = model.value.predict(part.column(part.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], names=names)


def predict(docs: DataFrame, model: Model | None, id_cols: list[str | Column], text_col: str = "text") -> DataFrame:
    """(ids, lang_pred, score, rejected) of every row, from its whole text; one narrow pass."""
    kept = docs.select(*id_cols, F.col(text_col).cast("string"))
    ids = kept.schema.fields[:-1]
    if model is None:
        return kept.select(*(F.col(f.name) for f in ids), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("rejected"))
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)   # bounded by the sample
    schema = T.StructType([*ids, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])
    names = schema.names
    return kept.mapInArrow(lambda it: returned(_predict_batches(it, sent, names)), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 by 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _keep_batches(batches: Iterable[pa.RecordBatch], model: object, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            rejected = model.value.predict(part.column(text_at).to_pylist())[2]
            yield part.filter(pa.array(~rejected))


def keep(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows that aren't rejected, with all their columns."""
    if model is None:
        return docs.limit(0)
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: returned(_keep_batches(it, sent, at)), docs.schema)
