"""Properties of the distributed ordering operators on skewed data."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courtload.operators import ordering
from courtload.operators.ordering import ntile_rows, rolling_rows, splitters


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        player = 0 if rnd.random() < 0.34 else rnd.randint(1, 40)   # one player holds a third of the rows
        data.append((player, i, rnd.choice([None, 1.0, 2.5, 3.0]) if i % 11 == 0 else rnd.random() * 100))
    return spark.createDataFrame(data, "player long, seq long, x double")


AGGS = {"s": ("sum", "x"), "a": ("avg", "x"), "c": ("count", "x")}


def _rows(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))


@pytest.mark.parametrize("n,chunk_rows", [(1, 10), (2, 1), (5, 3), (5, 97), (5, 1 << 20), (9, 10)])
def test_split_rolling_equals_window(spark, n, chunk_rows):
    df = _skewed(spark).withColumn("day", F.when(F.col("seq") % 13 != 0, F.floor(F.col("seq") / 7)))
    order, cols = ["day", "seq"], ("player", "seq", "s", "a", "c")
    window = _rows(rolling_rows(df, "player", order, n, AGGS, method="window"), *cols)
    assert _rows(rolling_rows(df, "player", order, n, AGGS, chunk_rows=chunk_rows), *cols) == window
    finer = [F.col("day"), F.floor(F.col("seq") / 2)]
    assert _rows(rolling_rows(df, "player", order, n, AGGS, split_on=finer, chunk_rows=chunk_rows), *cols) == window


def test_chunks_of_a_hot_player_stay_bounded(spark):
    df = _skewed(spark, n=6000)
    table = splitters(df, "player", [F.col("seq")], 5, 100)
    sent = df.drop("player").join(table, F.col("seq") == F.col("_s0")).select("player", F.posexplode("_to").alias("halo", "chunk"))
    sizes = sent.groupBy("player", "chunk").agg(F.count("*").alias("n"), F.count_if(F.col("halo") == 0).alias("own")).collect()
    assert max(r["own"] for r in sizes) <= 101 and max(r["n"] for r in sizes) <= 105 and len(sizes) > 55


@pytest.mark.parametrize("fetched,accuracy", [(10_000, 10_000), (3, 10_000), (3, 20)])
@pytest.mark.parametrize("order", [["x", "seq"], ["day", "seq"], ["player", "x", "seq"]])
def test_ntile_matches_sql_ntile(spark, monkeypatch, fetched, accuracy, order):
    monkeypatch.setattr(ordering, "FETCHED", fetched)
    monkeypatch.setattr(ordering, "ACCURACY", accuracy)
    df = _skewed(spark, n=1001).withColumn("day", F.when(F.col("seq") % 13 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (F.col("seq") / 40).cast("int"))))
    for n in (4, 7):
        got = ntile_rows(df, n, order)
        want = df.withColumn("want", F.ntile(n).over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
        assert got.join(want.select("seq", "want"), "seq").filter(F.col("tile") != F.col("want")).count() == 0
        sizes = sorted(r["count"] for r in got.groupBy("tile").count().collect())
        assert len(sizes) == n and sizes[-1] - sizes[0] <= 1


def test_ntile_of_few_rows(spark):
    df = _skewed(spark, n=3)
    assert sorted(r["tile"] for r in ntile_rows(df, 4, ["seq"]).collect()) == [1, 2, 3]
    assert ntile_rows(df.limit(0), 4, ["seq"]).count() == 0
    with pytest.raises(TypeError):
        ntile_rows(df.withColumn("t", F.lit("a")), 2, ["t", "seq"])


def test_only_parts_larger_than_a_chunk_are_cut(spark, monkeypatch):
    df, cut = _skewed(spark), []
    monkeypatch.setattr(ordering, "splitters", lambda rows, *a: cut.append(rows) or splitters(rows, *a))
    for chunk_rows in (500, 1 << 20):
        rolling_rows(df, "player", ["seq"], 5, AGGS, chunk_rows=chunk_rows)
    assert [{r["player"] for r in rows.select("player").distinct().collect()} for rows in cut] == [{0}, set()]


def test_rows_without_a_part_are_framed_too(spark):
    df = _skewed(spark, n=400).withColumn("player", F.when(F.col("player") > 20, F.col("player")))
    want = _rows(rolling_rows(df, "player", ["seq"], 5, AGGS, method="window"), "player", "seq", "s", "a", "c")
    for chunk_rows in (20, 1 << 20):
        assert _rows(rolling_rows(df, "player", ["seq"], 5, AGGS, chunk_rows=chunk_rows), "player", "seq", "s", "a", "c") == want
