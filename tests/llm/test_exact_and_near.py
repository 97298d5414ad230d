import collections
import hashlib
import itertools
import re

import pytest

from courtload.llm import block_names, near_dups
from courtload.llm.components import components, contracted
from tests.llm.helpers import docs, prose

LONG = prose(3, 6_000)
TEXTS = [(5, "a b\tc", "en"), (4, "abc", "en"), (9, "a  b  c", None), (None, "abc", None), (7, None, None), (8, "", "en"),
         (6, " \n\r\x0b\x0c", "en"), (10, LONG, "en"), (11, LONG + " ", "en"), (12, LONG + "x", "en"), (12, LONG + "x", "en"),
         (13, "é\u00a0é", "fr"), (14, "éé", "fr"), (15, "ab" * 40, "en"), (16, "ab" * 41, "en")]


def brute_exact(rows):
    white = re.compile("[\x20\x09-\x0d]")
    by = collections.defaultdict(list)
    for i, t, _ in rows:
        by[white.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, group in by.items():
        best = min(group)
        out += [(i, best[3], len(group), hashlib.sha256(norm.encode()).hexdigest()) for *_, i in group]
    return collections.Counter(out), {n: 1 for n in by}


@pytest.mark.parametrize("size", [16, 4096])
def test_exact_groups_match_brute_force(spark, tmp_path, size):
    got = block_names.groups(docs(spark, tmp_path / "d", TEXTS), block_bytes=size).collect()
    want, texts = brute_exact(TEXTS)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len(texts)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_keeps_columns_and_rows(spark, tmp_path):
    table = docs(spark, tmp_path / "d", TEXTS)
    left = block_names.keep_first(table)
    assert left.columns == table.columns
    assert left.count() == len(brute_exact(TEXTS)[1])
    assert {r["row"] for r in left.collect()} <= {f"r{k}" for k in range(len(TEXTS))}


def test_exact_of_nothing(spark, tmp_path):
    table = docs(spark, tmp_path / "d", [])
    assert block_names.groups(table).count() == 0
    assert block_names.keep_first(table).count() == 0


def changed(text, seed, share=40):
    words = text.split()
    return " ".join(f"{w}{seed}" if k % share == seed % share and k else w for k, w in enumerate(words))


def near_rows():
    base, short, other = prose(1, 200), "one two three", prose(2, 120)
    rows = [(100 + k, changed(base, k, 90), "en") for k in range(12)]          # a group of near copies
    rows += [(50, base, "en"), (51, base.upper(), "en"), (52, base, "de"), (52, base, "de")]
    rows += [(1, short, "en"), (2, "One  two\nthree", "en"), (3, "one two four", "en")]
    rows += [(None, other, None), (60, changed(other, 1, 60), None), (61, prose(9, 120), "en")]
    rows += [(70, None, None), (71, "", "en"), (72, "  \n", "en"), (80, LONG, "en"), (81, changed(LONG, 1, 200), "en")]
    rows += [(200 + k, other[:300] + " " + prose(30 + k, 60), "en") for k in range(8)]   # a shared passage, not alike
    return rows


def brute_near(rows):
    sets = []
    for _, t, _ in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            up[max(top(a), top(b))] = min(top(a), top(b))
    groups = collections.defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        groups[top(k)].append((i is None, i or 0, i))
    return collections.Counter((i, min(g)[2], len(g)) for g in groups.values() for *_, i in g), len(groups)


def test_near_classes_match_brute_force(spark, tmp_path):
    rows = near_rows()
    got = near_dups.classes(docs(spark, tmp_path / "d", rows)).collect()
    want, groups = brute_near(rows)
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    assert sum(r.kept for r in got) == groups


def test_near_keeps_one_of_each_group(spark, tmp_path):
    rows = near_rows()
    table = docs(spark, tmp_path / "d", rows)
    left = near_dups.keep_one(table)
    assert left.columns == table.columns and left.count() == brute_near(rows)[1]
    empty = docs(spark, tmp_path / "e", [])
    assert near_dups.classes(empty).count() == 0 and near_dups.keep_one(empty).count() == 0
    plain = docs(spark, tmp_path / "p", [(1, None, None), (2, "", None), (3, "a b", None)])
    assert near_dups.keep_one(plain).count() == 3


def test_signature_agrees_like_the_weighted_similarity():
    a, b = prose(1, 400), prose(1, 300) + " " + prose(4, 100)
    owner, key, count = near_dups.shingles([a, b])
    kept = near_dups.signatures(owner, key, count.astype(float), 2, 4999)
    x, y = (set(key[owner == k].tolist()) for k in (0, 1))
    assert abs((kept[0] == kept[1]).mean() - len(x & y) / len(x | y)) < 0.03
    assert (near_dups.signatures(owner, key, count.astype(float), 2) > 0).all()


def test_pivots_go_on_until_no_member_is_left(spark, tmp_path, monkeypatch):
    """All documents in one bucket: pairs of near copies that no first pivot is like are found by later ones."""
    rows = [(10 * k + j, changed(prose(50 + k, 80), j, 79), "en") for k in range(9) for j in (1, 2)]
    monkeypatch.setattr(near_dups, "band_keys", lambda kept: near_dups.np.ones((len(kept), 1), near_dups.np.int64))
    monkeypatch.setattr(near_dups, "_sign_batches", _one_bucket)
    got = near_dups.classes(docs(spark, tmp_path / "d", rows)).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(10 * k + j, 10 * k + 1) for k in range(9) for j in (1, 2)}


def _one_bucket(batches, words):
    import pyarrow as pa
    import xxhash
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([xxhash.xxh3_128_digest(t) for t in b.column(2).to_pylist()], pa.binary()),
             pa.array([[1]] * b.num_rows, pa.list_(pa.int64()))], names=["row", "id", "print", "bands"])


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (301, 300), (300, 302)]
    got = {r.node: r.component for r in components(contracted(spark.createDataFrame(edges, "a long, b long"))).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 300: 300, 301: 300, 302: 300}
    assert components(contracted(spark.createDataFrame([], "a long, b long"))).count() == 0
    first = components(contracted(spark.createDataFrame(edges[::2], "a long, b long")))
    more = spark.createDataFrame(edges[1::2], "a long, b long")
    assert {r.node: r.component for r in components(contracted(more, first), first).collect()} == got


@pytest.mark.parametrize("block", [2, 256])
def test_pairs_that_meet_no_linked_pivot_are_found(spark, tmp_path, monkeypatch, block):
    """One bucket of unlike documents, whose pivots link nothing, and two pairs of near copies among them."""
    rows = [(k, prose(200 + k, 60), "en") for k in range(30)]
    rows += [(100 + 10 * k + j, changed(prose(300 + k, 80), j, 79), "en") for k in range(2) for j in (1, 2)]
    monkeypatch.setattr(near_dups, "_sign_batches", _one_bucket)
    monkeypatch.setattr(near_dups, "BLOCK", block, raising=False)
    got = near_dups.classes(docs(spark, tmp_path / "d", rows)).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == brute_near(rows)[0]


@pytest.mark.parametrize("block", [2, 256])
def test_members_of_a_pivots_component_link_others(spark, tmp_path, monkeypatch, block):
    """A chain of edits in one bucket, each document alike with its neighbours only."""
    words = prose(400, 400).split()
    rows = [(k, " ".join(words[10 * k:10 * k + 100]), "en") for k in range(24)]
    monkeypatch.setattr(near_dups, "_sign_batches", _one_bucket)
    monkeypatch.setattr(near_dups, "BLOCK", block, raising=False)
    got = near_dups.classes(docs(spark, tmp_path / "d", rows)).collect()
    assert brute_near(rows)[1] == 1 and {(r.class_id, r.class_size) for r in got} == {(0, 24)}


def test_repeated_lines_that_differ(spark, tmp_path):
    """Bodies alike, a line repeated fifty times with another name in each: plain similarity is above 0.8."""
    rows = [(10 * k + j, f"{prose(500 + k, 42)} " + f"cast four of {j}name " * 50, "en") for k in range(20) for j in (1, 2)]
    want, groups = brute_near(rows)
    got = near_dups.classes(docs(spark, tmp_path / "d", rows)).collect()
    assert groups == 20 and collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want


def test_the_copy_of_the_texts_is_gone_after_their_shingles(spark, tmp_path):
    from pathlib import Path

    from courtload.session import checkpoint_root
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    rows = [(k, " ".join(f"w{(k // 2) * 100 + i}" for i in range(40)) + (" x" if k % 2 else ""), "en") for k in range(20)]
    before = set(root.rglob("texts-numbered-*"))
    got = near_dups.classes(docs(spark, tmp_path / "d", rows))
    assert not set(root.rglob("texts-numbered-*")) - before
    assert {r.doc_id: r.class_id for r in got.collect()} == {k: k // 2 * 2 for k in range(20)}
