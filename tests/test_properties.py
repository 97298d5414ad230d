"""Properties from SURVEY §5 on the sf0.001 tables."""

from pyspark.sql import functions as F

from courtload.operators import joins, risk, workload
from courtload.plans.graph import Graph
from tests.conftest import SF_SMALL


def test_fanout_factor_is_sum_of_n_times_m(spark):
    g = Graph.of(spark, SF_SMALL)
    pairs = g.keyed.agg(F.sum("pair_rows")).first()[0]
    literal = g.d.tracking.join(g.d.stats, ["game_id", "player_id"]).count()
    assert pairs == literal


def test_label_classes_sum_to_snapshots(spark):
    g = Graph.of(spark, SF_SMALL)
    balance = {r[risk.LABEL]: r["count"] for r in risk.label_balance(g.features).collect()}
    assert set(balance) <= {0, 1}
    assert sum(balance.values()) == risk.workload_snapshot(g.rolling).count() == g.features.count()


def test_workload_tier_sizes_differ_by_at_most_one(spark):
    g = Graph.of(spark, SF_SMALL)
    from courtload.operators.ordering import ntile_rows
    tiered = ntile_rows(g.rolling, 4, ["rolling_5g_distance", "player_id", "game_id", "team_id", "date"], out="t")
    sizes = [r["count"] for r in tiered.groupBy("t").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    assert len(workload.workload_tiers(g.rolling).collect()) == 4


def test_schedule_join_equals_or_join(spark):
    g = Graph.of(spark, SF_SMALL)
    s, sc = g.training_team, g.d.schedule
    orj = s.join(sc, (s.date == sc.date) & ((s.team_id == sc.home_team) | (s.team_id == sc.away_team)),
                 "left").drop(sc.date)
    mine = joins.join_schedule(s, sc)
    cols = sorted(mine.columns)
    assert sorted(map(tuple, mine.select(cols).collect()), key=repr) == \
        sorted(map(tuple, orj.select(cols).collect()), key=repr)
