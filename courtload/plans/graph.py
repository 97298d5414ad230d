"""The lazy dataset graph of the batch job.

Each property is a lazy DataFrame built from the ones before it; nothing
runs until a caller acts.  ``plans.batch`` materialises the reused nodes.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from courtload import config
from courtload.operators import impact, joins, risk, training, workload
from courtload.operators.clean import parse_dates
from courtload.sources.adapters import Domain, load_domain


class Graph:
    def __init__(self, domain: Domain, rolling_method: str = "split", grain: str = "literal",
                 split_share: float | None = None, pairs: int | None = None, deal: bool = False, weigh: bool = False):
        """``split_share``: J4 looks its hot (date, team) keys up when it is built, and splits those with such a share of the
        sessions; None leaves skew to adaptive execution, and nothing runs while the graph is built.
        ``pairs``: J4 counts its joined rows when it is built, and makes about so many in a task (``joins.pair_parts``).
        ``deal``: J1 looks its keys up when it is built, and deals the raw rows by key unless one holds many of them.
        ``weigh``: A12 and A15a read J4 summed up per session (``joins.schedule_weights``) instead of its rows."""
        self.d = domain
        self.rolling_method = rolling_method
        self.grain = grain
        self.split_share = split_share
        self.pairs = pairs
        self.deal = deal
        self.weights = training.J4_WEIGHTS if weigh else None
        #: Small table of the (player, game) with several rolling rows, if known: D2 groups only these.
        self.repeated: DataFrame | None = None
        #: Rows of A15, if its joins are to be dealt by player once (``risk.injury_risk_features``).
        self.feature_rows = 0
        #: Rows of the per-game table, where it is pinned (``pin_games``): W1's partitions follow them.
        self.game_rows = 0

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, **kw) -> "Graph":
        return cls(load_domain(spark, sf_dir), **kw)

    def pin(self, name: str, df: DataFrame) -> DataFrame:
        """Replace node ``name`` (e.g. by its written copy); later nodes build on it."""
        if not isinstance(getattr(type(self), name, None), cached_property):
            raise AttributeError(name)
        self.__dict__[name] = df
        return df

    def pin_games(self, df: DataFrame) -> DataFrame:
        """``pin`` the written per-game table and count its rows."""
        self.game_rows = df.count()
        return self.pin("pgw", df)

    # --- joins -------------------------------------------------------------------
    @cached_property
    def raw_spread(self) -> joins.Spread:
        """How J1's raw rows lie over its keys, and how many they are; looked up under ``deal`` (else not even, 0)."""
        if not self.deal or "summaries" in self.__dict__:
            return joins.Spread(False, 0)
        return joins.sides_spread(self.d.tracking, self.d.stats)

    @property
    def raw_dealt(self) -> bool:
        """Whether J1's sides come dealt by key from the raw rows."""
        return self.raw_spread.even

    @cached_property
    def summaries(self) -> tuple[DataFrame, DataFrame]:
        """J1's sides at key grain: (tracking summary, box-score summary)."""
        return joins.side_summaries(self.d.tracking, self.d.stats, deal=self.raw_dealt, rows=self.raw_spread.rows)

    @cached_property
    def keyed(self) -> DataFrame:
        """J1 at (game, player, team) grain."""
        t, s = self.summaries
        return joins.join_summaries(t, s, grain=self.grain, deal=not self.raw_dealt, rows=self.raw_spread.rows)

    @cached_property
    def keyed_sched(self) -> DataFrame:
        """J1 + J5."""
        return joins.schedule_context(self.keyed, self.d.schedule)

    @cached_property
    def training_clean(self) -> DataFrame:
        return parse_dates(self.d.training, ["date"])

    @cached_property
    def team_source(self) -> DataFrame:
        """Rows carrying (player_id, team_id) for J3's bridge: the tracking rows, or any
        per-key summary of them (the batch job pins its written tracking summary)."""
        return self.d.tracking

    @cached_property
    def training_team(self) -> DataFrame:
        return joins.attach_team(self.training_clean, self.team_source)

    @cached_property
    def training_sched(self) -> DataFrame:
        """J3 + J4 (training_with_schedule)."""
        split = joins.hot_keys(self.training_team, ["date", "team_id"], self.split_share) if self.split_share else None
        return joins.join_schedule(self.training_team, self.d.schedule, split=split, pairs=self.pairs)

    @cached_property
    def training_rows(self) -> DataFrame:
        """What A12 and A15a group: J4's rows, or under ``weigh`` J4 summed up per session."""
        return self.training_sched if self.weights is None else joins.schedule_weights(self.training_team, self.d.schedule)

    # --- workload ------------------------------------------------------------------
    @cached_property
    def pgw(self) -> DataFrame:
        if "keyed_sched" in self.__dict__:      # pinned, or built for another node
            return workload.player_game_workload(self.keyed_sched)
        return workload.player_game_workload(joins.schedule_context(self.keyed, self.d.schedule, deal=True, rows=self.raw_spread.rows))

    @cached_property
    def teams(self) -> DataFrame | None:
        """A team of each player (``workload.first_teams``), where it is pinned: the rolling rows then come in ranges of it."""
        return None

    @cached_property
    def rolling(self) -> DataFrame:
        return workload.rolling_workload(self.pgw, method=self.rolling_method, rows=self.game_rows, teams=self.teams)

    @cached_property
    def profile(self) -> DataFrame:
        return workload.season_profile(self.pgw)

    @cached_property
    def thresholds(self) -> DataFrame:
        # The reference reads these off rolling_workload; the two columns used are
        # per-game values the rolling step only carries along (one row per game),
        # so the per-game table gives the same thresholds without the frame work.
        return workload.player_thresholds(self.pgw)

    # --- impact --------------------------------------------------------------------
    @cached_property
    def btb(self) -> DataFrame:
        return impact.back_to_back_analysis(self.keyed_sched)

    @cached_property
    def resilience(self) -> DataFrame:
        return impact.resilience(impact.back_to_back_pivot(self.btb))

    # --- training ------------------------------------------------------------------
    @cached_property
    def load(self) -> DataFrame:
        return training.training_load_analysis(self.training_rows, self.weights)

    @cached_property
    def weekly(self) -> DataFrame:
        return training.weekly_training(self.training_clean, config.HIGH_INTENSITY)

    @cached_property
    def week_perf(self) -> DataFrame:
        return training.join_week_performance(self.weekly, self.pgw)

    # --- risk ----------------------------------------------------------------------
    @cached_property
    def incidents(self) -> DataFrame:
        return risk.dated_incidents(self.d.incidents)

    @cached_property
    def features(self) -> DataFrame:
        return risk.injury_risk_features(self.rolling, self.incidents, self.training_rows, repeated=self.repeated, weights=self.weights,
                                         rows=self.feature_rows)
