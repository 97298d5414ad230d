"""Increments equal the full run, rewrite only the partitions they reach, and may be added again."""

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtload.operators import joins
from courtload.plans.graph import Graph
from courtload.plans.increment import STATS_KEYS, TRACK_KEYS, Increments, merge_summaries
from courtload.session import scratch_path
from courtload.sources.adapters import Domain
from tests.conftest import SF_SMALL


def _near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _same(got, want, keys):
    cols = sorted(want.columns)
    a, b = ([tuple(r) for r in d.orderBy(*keys).select(*keys, *cols).collect()] for d in (got, want))
    assert len(a) == len(b) and all(_near(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


def _split(d, cond):
    return [Domain(*(t.where(c) for t in (d.tracking, d.stats, d.schedule)), d.training, d.incidents) for c in (cond, ~cond)]


def _files(root, table):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root, table).rglob("*.parquet")}


def _root(spark, name):
    return scratch_path(spark, name).removeprefix("file:")


def test_one_more_game_rewrites_only_its_partitions(spark):
    g = Graph.of(spark, SF_SMALL)
    game = g.keyed.groupBy("game_id").count().orderBy("count", "game_id").first()["game_id"]
    rest, one = _split(g.d, F.col("game_id") != game)
    root = _root(spark, "inc")
    kept = Increments(spark, root, parts=16)
    kept.add("rest", rest)
    before = {t: _files(root, t) for t in ("player_game_workload", "rolling_workload")}
    kept.add("one", one)
    after = {t: _files(root, t) for t in before}
    changed = {t: {p.split("/")[1] for p in after[t].keys() ^ before[t].keys()} for t in before}
    assert len(changed["player_game_workload"]) == 1
    players = [r[0] for r in g.pgw.where(F.col("game_id") == game).select("player_id").distinct().collect()]
    teams = {f"team_id={r[0]}" for r in g.pgw.where(F.col("player_id").isin(players)).select("team_id").distinct().collect()}
    assert changed["rolling_workload"] == teams
    assert len({p.split("/")[1] for p in after["rolling_workload"]}) > len(teams)
    order = ["player_id", "game_id", "team_id"]
    _same(kept.rolling(), g.rolling, order)
    _same(kept.player_games().drop("game_part"), g.pgw, order)


def test_pieces_of_games_added_twice_and_compacted(spark):
    g = Graph.of(spark, SF_SMALL)
    d = g.d
    kept = Increments(spark, _root(spark, "inc-pieces"), parts=4)
    odd = F.pmod(F.xxhash64("player_id", "heart_rate_bpm"), F.lit(2)) == 1
    empty = d.schedule.limit(0)
    a = Domain(d.tracking.where(odd), d.stats.limit(0), empty, d.training, d.incidents)
    b = Domain(d.tracking.where(~odd), d.stats, empty, d.training, d.incidents)
    late = Domain(d.tracking.limit(0), d.stats.limit(0), d.schedule, d.training, d.incidents)
    kept.add("a", a)
    kept.add("b", a)                 # the wrong rows, then the right ones under the same id
    kept.add("b", b)
    kept.compact()
    kept.compact()
    kept.add("late", late)
    kept.add("none", Domain(d.tracking.limit(0), d.stats.limit(0), empty, d.training, d.incidents))
    _same(kept.rolling(), g.rolling, ["player_id", "game_id", "team_id"])
    with pytest.raises(ValueError):
        kept.add("a", a)
    assert [f["ids"] for f in kept.listed()] == [["a", "b"], ["late"], ["none"]]


def test_merged_summaries_equal_those_of_all_rows(spark):
    d = Graph.of(spark, SF_SMALL).d
    shifted = d.tracking.withColumn("heart_rate_bpm", F.when(F.col("speed_mph") > 3, F.col("heart_rate_bpm") + 1e6))
    t, s = joins.side_summaries(shifted, d.stats)
    halves = [joins.side_summaries(shifted.where(c), d.stats.where(c2)) for c, c2 in
              ((F.col("speed_mph") > 12, F.col("points") > 5), (F.col("speed_mph") <= 12, F.col("points") <= 5))]
    whole = [shifted.count(), d.stats.count()]
    assert [sum(h[i].agg(F.sum(n)).first()[0] for h in halves) for i, n in enumerate(("n_track", "n_stats"))] == whole
    _same(merge_summaries(halves[0][0].unionByName(halves[1][0]), TRACK_KEYS), t, list(TRACK_KEYS))
    _same(merge_summaries(halves[0][1].unionByName(halves[1][1]), STATS_KEYS), s, list(STATS_KEYS))


def test_nothing_added_yet(spark):
    with pytest.raises(FileNotFoundError):
        Increments(spark, _root(spark, "inc-none")).rolling()


def test_rows_of_increments_move_once(spark, monkeypatch):
    from courtload.plans import increment
    d, plans, publish = Graph.of(spark, SF_SMALL).d, [], increment.publish

    def seen(df, path, *a, **kw):
        plans.append((path.split("/")[-2] if "increment=" in path else path.split("/")[-1], df._jdf.queryExecution().executedPlan().toString()))
        return publish(df, path, *a, **kw)
    monkeypatch.setattr(increment, "publish", seen)
    monkeypatch.setattr(joins, "DEALT_ROWS", 500)
    kept = Increments(spark, _root(spark, "inc-moves"), parts=4)
    first, last = _split(d, F.col("game_id") % 40 != 0)
    kept.add("first", first)
    kept.add("last", last)
    assert [name for name, _ in plans] == [*increment.KINDS, "player_game_workload", "rolling_workload"] * 2
    for name, plan in plans:
        assert plan.count("Exchange rangepartitioning") == (name == "rolling_workload")     # W1's own
    (_, whole), (_, kept_beside) = [p for p in plans if p[0] == "player_game_workload"]
    assert whole.count("Exchange hashpartitioning") == 3 and "LeftAnti" not in whole       # tracking, box scores, schedule
    assert "LeftAnti" in kept_beside
    _same(kept.rolling(), Graph.of(spark, SF_SMALL).rolling, ["player_id", "game_id", "team_id"])
    # a task holds games of one part: at most as many files as partitions
    assert len(_files(kept.root, "summaries/tracking")) <= 16 + 4


def test_an_increment_that_died_is_made_up_for(spark, monkeypatch):
    g = Graph.of(spark, SF_SMALL)
    a, rest = _split(g.d, F.col("game_id") % 3 == 0)
    b, c = _split(rest, F.col("game_id") % 3 == 1)
    kept = Increments(spark, _root(spark, "inc-died"), parts=1)
    kept.add("a", a)
    monkeypatch.setattr(kept, "_rebuild", lambda *a, **kw: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.add("b", b)
    monkeypatch.undo()
    kept.add("c", c)                 # the part's other games are not taken from the table as it is
    _same(kept.player_games().drop("game_part"), g.pgw, ["player_id", "game_id", "team_id"])
    assert [f["done"] for f in kept.listed()] == [True, False, True]
    kept.add("b", b)
    assert all(f["done"] for f in kept.listed())
    _same(kept.rolling(), g.rolling, ["player_id", "game_id", "team_id"])


def test_parts_by_another_hash_are_refused(spark):
    import json

    from courtload.session import replace_text
    kept = Increments(spark, _root(spark, "inc-old"))
    replace_text(spark, f"{kept.root}/_increments", json.dumps({"folder": "increment=0", "ids": ["a"], "schemas": {}}))
    with pytest.raises(ValueError, match="another hash"):
        kept.listed()
