"""Passes over one table agree on its rows though each splits the scan in its own way, as on a cluster that grows or shrinks."""

import pytest

from courtload.llm import block_names, common, multi_index, near_dups
from tests.llm.helpers import docs, prose


@pytest.fixture
def unsteady(spark, monkeypatch):
    """After each table that is written, scans are split for another number of cores."""
    keys = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    writes = []

    def materialize(df, name):
        out = common_materialize(df, name)
        writes.append(name)
        spark.conf.set(keys[0], "16" if len(writes) % 2 else "2")
        return out
    common_materialize = common.materialize
    spark.conf.set(keys[1], "1")
    spark.conf.set(keys[0], "2")
    for module in (common, block_names, near_dups, multi_index):
        monkeypatch.setattr(module, "materialize", materialize)
    yield writes
    for k in keys:
        spark.conf.unset(k)


TEXTS = [prose(k, 40) for k in range(300)]
ROWS = [(k, TEXTS[k % 300] if k % 5 else TEXTS[k % 300] + " and one more", "en") for k in range(1000)]


def test_exact_dedup_keeps_every_text(spark, tmp_path, unsteady):
    table = docs(spark, tmp_path / "d", ROWS, parts=12)
    texts = {t for _, t, _ in ROWS}
    found = block_names.groups(table).collect()
    assert sorted(r.doc_id for r in found) == list(range(1000))
    first = {t: min(i for i, u, _ in ROWS if u == t) for t in texts}
    assert all(r.keep_id == first[ROWS[r.doc_id][1]] for r in found)
    kept = block_names.keep_first(table).collect()
    assert sorted(r.doc_id for r in kept) == sorted(first.values()) and unsteady
    assert {r.text for r in kept} == texts


def test_near_dedup_keeps_one_of_each_group(spark, tmp_path, unsteady):
    table = docs(spark, tmp_path / "d", ROWS, parts=12)
    found = {r.doc_id: r.class_id for r in near_dups.classes(table).collect()}
    want = {k: k % 300 for k in range(1000)}
    assert found == want
    assert sorted(r.doc_id for r in near_dups.keep_one(table).collect()) == sorted(set(want.values())) and unsteady


def test_vectors_are_linked_as_before(spark, tmp_path, unsteady):
    rows = [(k, [float(j == k % 40) + 0.001 * (k % 7) for j in range(40)], k % 2) for k in range(600)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(12).write.parquet(str(tmp_path / "v"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in multi_index.groups(spark.read.parquet(str(tmp_path / "v"))).collect()}
    assert got == {k: (14, k % 40) for k in range(600)} and unsteady
