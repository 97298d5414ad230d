import pytest

import __spark_entry__ as entry
import corpus_pipeline
from courtload.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import duck, table
from tests.llm.helpers import docs, prose


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert table(QUERIES[name](spark, SF_SMALL).toPandas()) == table(duck(SF_SMALL).sql(ORACLE[name]).df())


def test_every_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "packing"]


def test_stages_keep_what_they_should(spark, tmp_path):
    base = prose(1, 300)
    words = base.split()
    words[150] = "changed"
    rows = [(1, base, "aa"), (2, base.replace(" ", "  "), "aa"), (3, " ".join(words), "aa"), (4, "12345 !!", None), (5, None, None)]
    rows += [(100 + k, prose(20 + k, 120), "aa") for k in range(60)]
    left, sf = docs(spark, tmp_path / "documents.parquet", rows), str(tmp_path)
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, left, sf)
        if k < 3:
            assert out.columns == left.columns
        out.write.parquet(str(tmp_path / f"s{k}"))
        left = spark.read.parquet(str(tmp_path / f"s{k}"))
        counts.append(left.count())
    assert counts[:3] == [63, 62, 61]
    ids = {r.doc_id for r in left.collect()}
    assert ids == {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} and 2 in ids and len(ids & {1, 3}) == 0


def test_pipeline_of_nothing(spark, tmp_path):
    docs(spark, tmp_path / "documents.parquet", [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
