import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtload.llm import common, hilbert, lang_id, multi_index
from tests.llm.helpers import docs, prose


def vectors():
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(60):
            v = rng.normal(size=16)
            for copy in range(int(rng.integers(1, 4))):
                rows.append((n, (v + copy * rng.normal(size=16) * 0.02).tolist(), label))
                n += 1
    hot = rng.normal(size=16)
    rows += [(n + k, (hot + rng.normal(size=16) * 0.06).tolist(), 1) for k in range(700)]   # more than two blocks
    return rows + [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [1.0, None] * 8, 1), (5003, [float("nan")] * 16, 1), (5004, [float("inf")] * 16, 1),
                   (5005, [], 1), (5006, [1.0, 2.0], 1), (5007, [2.0, 4.0], 1), (5008, [1e-200, 2e-200], 1), (5009, [1e200, 2e200], 1),
                   (5010, [1.0, 2.0], 2), (5010, [1.0, 2.0], 2)]


def brute_vectors(rows):
    n, up = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    fine = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / max(map(abs, v))
            fine.setdefault((label, len(v)), []).append((k, x / np.linalg.norm(x)))
    for group in fine.values():
        m = np.stack([x for _, x in group])
        for i, j in np.argwhere(np.triu(m @ m.T >= 0.98, 1)):
            a, b = group[i][0], group[j][0]
            n[a] += 1
            n[b] += 1
            up[max(top(a), top(b))] = min(top(a), top(b))
    return sorted((rows[k][0], n[k], rows[top(k)][0]) for k in range(len(rows)))


@pytest.mark.parametrize("pairs", [500, 1 << 40])    # the reach measured, or the whole radius
def test_links_and_components_match_brute_force(spark, tmp_path, monkeypatch, pairs):
    monkeypatch.setattr(multi_index, "PAIRS", pairs)
    rows = vectors()
    spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, cell string").repartition(3).write.parquet(
        str(tmp_path / "v"))
    got = multi_index.groups(spark.read.parquet(str(tmp_path / "v"))).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute_vectors([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in multi_index.groups(table).collect())
    found, there = sum(x[1] for x in got), sum(x[1] for x in want)
    assert found >= 0.9 * there and all(g[1] <= w[1] for g, w in zip(got, want))


@pytest.mark.parametrize("size,rank", [(64, 4), (256, 4), (768, 4), (256, 6), (768, 6)])
def test_recall_on_low_rank_vectors(spark, tmp_path, monkeypatch, size, rank):
    monkeypatch.setattr(multi_index, "CENTROIDS", 64)
    rng = np.random.default_rng(size + rank)
    turn = np.linalg.qr(rng.normal(size=(size, rank)))[0].T if rank == 6 else np.eye(rank, size)
    base = np.repeat(rng.normal(size=(300 if size > 500 else 500, rank)), 5, axis=0)
    x = (base + 0.12 * rng.normal(size=base.shape)) @ turn
    spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(4).write.parquet(
        str(tmp_path / "v"))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.98).sum(1) - 1
    got = {r.vec_id: r.n_links for r in multi_index.groups(spark.read.parquet(str(tmp_path / "v"))).collect()}
    assert want.sum() > 1000 and sum(got.values()) >= 0.95 * want.sum() and all(got[k] <= n for k, n in enumerate(want.tolist()))


def test_sample_is_bounded_whatever_the_ids_are(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(multi_index, "SAMPLE", 200)
    seen = []
    monkeypatch.setattr(multi_index, "unit", lambda rows, plain=multi_index.unit: seen.append(len(rows)) or plain(rows))
    rng = np.random.default_rng(2)
    for ids in ([None] * 3000, [7] * 3000):
        rows = [(i, rng.normal(size=4).tolist(), 1) for i in ids]
        path = str(tmp_path / f"v{ids[0]}")
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(path)
        numbered, row = common.numbered(spark.read.parquet(path), "v")
        multi_index.fit(numbered, "embedding", "label", ["vec_id", row], sample=200)
    assert seen and max(seen) < 300


def test_vectors_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "v"))
    assert multi_index.groups(spark.read.parquet(str(tmp_path / "v"))).count() == 0


def test_traversal_goes_by_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(7)
    got = multi_index.traversal(a, b, 0.7)
    want = sorted(((a[i] ** 2 + b[j] ** 2), i, j) for i in range(9) for j in range(7) if a[i] ** 2 + b[j] ** 2 <= 0.49)
    assert got == [(i, j) for _, i, j in want]


@pytest.mark.parametrize("d,bits", [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_every_point_by_single_steps(spark, d, bits):
    points = list(itertools.product(range(1 << bits), repeat=d))
    axes = [F.col(f"x{i}") for i in range(d)]
    rows = spark.createDataFrame(points, ", ".join(f"x{i} int" for i in range(d))).withColumn("h", hilbert.curve_index(axes, bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(points)))
    assert all(sum(abs(p[i] - q[i]) for i in range(d)) == 1 for p, q in zip(rows, rows[1:]))


ROWS = [(None, "x", None), (1, None, None), (2, "", "en"), (3, prose(1, 20_000), "de"), (3, "same", "en"), (3, "same", "en")] + \
       [(10 + k, prose(k, 5 + k % 50), random.Random(k).choice(["en", "de", None])) for k in range(300)]


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_hold_their_law(spark, tmp_path, law):
    table = docs(spark, tmp_path / "d", ROWS, 5)
    got = hilbert.shards(table, ["lang", "source", "n_chars"], law=law).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, len((t or "").encode()) + 16) for i, t, _ in ROWS)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(40)) and all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())
    if law == "rows":
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 40
    else:
        biggest = max(r.size for r in got)
        mean = sum(r.size for r in got) / 40
        assert max(sum(r.size for r in s) for s in by.values()) <= mean + biggest
    assert {r.law for r in got} == {law} and all(r.grown_shard is None for r in got)


def test_few_or_no_rows_to_shard(spark, tmp_path):
    assert hilbert.shards(docs(spark, tmp_path / "e", []), ["lang", "n_chars"]).count() == 0
    got = hilbert.shards(docs(spark, tmp_path / "f", ROWS[:3]), ["lang", "n_chars"]).collect()
    assert sorted(r.slot for r in got) == [0, 0, 0] and len({r.shard for r in got}) == 3
    with pytest.raises(ValueError):
        hilbert.shards(docs(spark, tmp_path / "g", ROWS[:3]), ["lang"], law="key")


def test_the_plan_has_no_python(spark, tmp_path):
    plan = hilbert.shards(docs(spark, tmp_path / "d", ROWS), ["lang", "source", "n_chars"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_long_texts_and_rows_without_ids_train_too(spark, tmp_path):
    long = [(k, "Öüß äö " * 4000 + prose(k, 3), "bb") for k in range(30)]
    short = [(None, prose(k, 60), "aa") for k in range(900)] + [(77, prose(5, 60), "aa")] * 500
    table = docs(spark, tmp_path / "d", long + short)
    model = lang_id.fit(table, docs_per_lang=20)
    assert sorted(model.langs) == ["aa", "bb"]
    got = lang_id.predict(table, model, ["doc_id", "lang"]).collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_held_out_accuracy(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = lang_id.fit(table.where(~lang_id.held_out()))
    got = lang_id.predict(table, model, ["doc_id", "lang", lang_id.held_out().alias("held_out")]).where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 1000 and sum(r.lang == r.lang_pred for r in got) > 0.99 * len(got)
    assert sum(r.rejected for r in got) < 0.005 * len(got)
    strange = lang_id.predict(docs(spark, tmp_path / "strange", [(1, "Съешь ещё этих мягких французских булок " * 20, None)]), model, ["doc_id"]).first()
    assert strange.rejected and strange.lang_pred in model.langs


def test_language_edge_cases(spark, tmp_path):
    rows = [(k, prose(k, 400 + k) if k % 2 else "Öüß " * (5 + k), "aa" if k % 2 else "bb") for k in range(80)]
    table = docs(spark, tmp_path / "d", [*rows, (500, None, "aa"), (None, "", None), (501, "12 34 !", None), (502, prose(1, 400_000), None), (503, "x", None)])
    model = lang_id.fit(table.where(~lang_id.held_out()))
    got = {r.doc_id: r for r in lang_id.predict(table, model, ["doc_id"]).collect()}
    assert {got[k].lang_pred for k in (500, None, 501)} == {"und"} and got[501].score == 0 and got[501].rejected
    assert got[502].lang_pred == "aa" and got[503].lang_pred in ("aa", "bb") and all(0 <= r.score <= 1 for r in got.values())
    kept = lang_id.keep(table, model)
    assert kept.columns == table.columns and {500, 501}.isdisjoint(r.doc_id for r in kept.collect())
    empty = docs(spark, tmp_path / "e", [])
    assert lang_id.fit(empty) is None and lang_id.predict(table, None, ["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert lang_id.predict(empty, model, ["doc_id"]).count() == 0 and lang_id.keep(table, None).count() == 0


def test_models_are_distributions(spark):
    """Over the alphabet with an unknown character, each context's probabilities sum to 1."""
    grams = np.array([[ord(c) for c in "  ab abcabcabdabcaab"[i:i + 4]] for i in range(17)])
    model = lang_id.build(["x"], np.zeros(len(grams), int), grams, np.arange(1, len(grams) + 1))
    alphabet = sorted({*grams.ravel().tolist(), 0x4E00})
    for context in ("  a", "abc", "zzz", "cab"):
        chars = np.array([[*map(ord, context), c] for c in alphabet], np.uint64)
        logp = model.score(chars.ravel(), np.arange(len(alphabet)) * 4 + 3)
        assert np.exp(logp[:, 0].astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_a_text_scores_the_same_in_pieces(monkeypatch, spark):
    rows = [prose(1, 3000), "Öüß " * 50, ""]
    grams, _, counts, _ = lang_id.characters(rows)
    at = np.flatnonzero(counts)
    chars = np.column_stack([grams[at - k] for k in (3, 2, 1, 0)]).astype(np.int64)
    model = lang_id.build(["x"], np.zeros(len(chars), int), chars, np.ones(len(chars)))
    whole = model.entropies(rows)
    monkeypatch.setattr(lang_id, "_PIECE", 1000)
    cut = model.entropies(rows)
    assert np.allclose(whole[0], cut[0], rtol=1e-5) and (whole[1] == cut[1]).all()
