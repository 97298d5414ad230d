"""Joins (J1-J11).

J1 joins tracking samples to box-score rows on (game, player): many to many.
Every consumer of that join aggregates it, so the pairs are never built:
each side is reduced to one row per key (count, sum, non-NULL count, centred
sum of squares per measure), the two summaries are joined 1:1, and the fanned-out
aggregates are recovered exactly -- a tracking measure appears once per stats
row of its key (weight ``n_stats``), a stats measure once per tracking row
(weight ``n_track``).  Partial aggregation runs before the shuffle, so a key
holding a third of all rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtload.session import materialize

TRACK_MEASURES = ("distance_covered_ft", "heart_rate_bpm", "speed_mph")
STATS_MEASURES = ("minutes_played", "points", "plus_minus", "shot_attempts", "shot_made")
SPREAD = ("heart_rate_bpm", "plus_minus")           # sums of squared deviations, for the correlations (A11)


def _side_summary(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count_name: str,
                  extra: Sequence[Column] = ()) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for m in measures:
        aggs += [F.sum(m).alias(f"s_{m}"), F.count(m).alias(f"c_{m}")]
        if m in SPREAD:
            # centred at the key's own mean, so that large offsets don't cancel
            aggs.append((F.var_pop(m) * F.count(m)).alias(f"m2_{m}"))
    return df.groupBy(*keys).agg(*aggs, *extra)


GRAINS = ("literal", "pre_aggregated")


def side_summaries(tracking: DataFrame, stats: DataFrame, keys: Sequence[str] = ("game_id", "player_id"),
                   team: str = "team_id", track_extra: Sequence[Column] = (),
                   deal: bool | Sequence[str] = False, rows: int = 0) -> tuple[DataFrame, DataFrame]:
    """J1's two sides reduced to one row per key: (game, player, team) and (game, player).

    ``track_extra`` adds aggregates to the tracking summary, so other per-row
    checks (the impossible-value gate) ride along the same scan of the raw rows.
    ``deal``: where most keys hold few rows (``spread_out``) partial sums before the shuffle save nothing, and a scan task
    would hold those of all its keys.  The raw rows are then dealt by key first and summed up where they arrive; by some
    columns of the key alone if these are given.
    ``rows``: those of the larger side, if known (see ``dealt``).
    """
    if deal:
        by = keys if deal is True else deal
        tracking, stats = dealt(tracking, *by, rows=rows), dealt(stats, *by, rows=rows)
    t = _side_summary(tracking, [*keys, team], TRACK_MEASURES, "n_track", track_extra)
    s = _side_summary(stats, list(keys), STATS_MEASURES, "n_stats")
    return t, s


def join_summaries(t: DataFrame, s: DataFrame, keys: Sequence[str] = ("game_id", "player_id"),
                   grain: str = "literal", deal: bool = True, rows: int = 0) -> DataFrame:
    """J1 from the side summaries (see ``join_tracking_stats``).  ``deal``: False if they are dealt by ``keys`` already;
    ``rows``: see ``dealt``."""
    return _weighted((dealt(t, *keys, rows=rows) if deal else t).join(s, list(keys), "inner"), grain)


def outer_summaries(t: DataFrame, s: DataFrame, keys: Sequence[str] = ("game_id", "player_id"),
                    deal: bool = True, rows: int = 0) -> DataFrame:
    """J1's sides side by side, matched or not, so that one table holds both; ``deal``, ``rows``: as in ``join_summaries``.

    ``n_track`` is NULL for a box-score key without tracking, ``n_stats`` for tracking without a box score; a box-score key
    comes once per team of its tracking.
    """
    return (dealt(t, *keys, rows=rows) if deal else t).join(s, list(keys), "full_outer")


LISTED = ("_nth", "_listed")


def listed(schedule: DataFrame, key: str = "game_id") -> DataFrame:
    """The schedule's rows with a game, numbered within their game (``_nth``) and with the game's rows (``_listed``)."""
    order = [F.col(c).asc_nulls_first() for c in SCHEDULE_CONTEXT]
    return (schedule.where(F.col(key).isNotNull())
            .withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
            .withColumn("_listed", F.count(F.lit(1)).over(Window.partitionBy(key))))


def scheduled_summaries(t: DataFrame, s: DataFrame, schedule: DataFrame, keys: Sequence[str] = ("game_id", "player_id"),
                        key: str = "game_id", rows: int = 0) -> DataFrame:
    """``outer_summaries`` with J5's columns, where both summaries lie dealt by ``key`` alone: no row moves again.

    A key comes once for each schedule row of its game; ``_nth`` numbers them (NULL without one), ``_listed`` is how many there
    are, and ``_teams`` the teams that the key's tracking has.  Write it under ``dealt_by_part``.
    """
    teams = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    games = listed(dealt(schedule.select(key, *SCHEDULE_CONTEXT), key, rows=rows), key)
    return outer_summaries(t.withColumn("_teams", teams), schedule_context(s, games, key, extra=LISTED), keys, deal=False)


def first_listed(sides: DataFrame) -> DataFrame:
    """``outer_summaries`` again from ``scheduled_summaries``."""
    return sides.where(F.coalesce(F.col("_nth"), F.lit(1)) == 1).drop(*SCHEDULE_CONTEXT, *LISTED, "_teams")


@contextmanager
def dealt_by_part(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside join tables that lie dealt by a part of the join's key as they are."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def matched_summaries(sides: DataFrame, grain: str = "literal") -> DataFrame:
    """J1 from ``outer_summaries``: as ``join_summaries``, without another join."""
    return _weighted(sides.where(F.col("n_track").isNotNull() & F.col("n_stats").isNotNull()), grain)


def _weighted(matched: DataFrame, grain: str) -> DataFrame:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    j = matched.withColumn("pair_rows", F.col("n_track") * F.col("n_stats"))
    if grain == "literal":
        return (j.withColumn("w_track", F.col("n_stats")).withColumn("w_stats", F.col("n_track"))
                 .withColumn("w_rows", F.col("pair_rows")))
    one = F.lit(1).cast("long")
    return j.withColumn("w_track", one).withColumn("w_stats", one).withColumn("w_rows", one)


def join_tracking_stats(tracking: DataFrame, stats: DataFrame,
                        keys: Sequence[str] = ("game_id", "player_id"),
                        team: str = "team_id", grain: str = "literal") -> DataFrame:
    """J1 at key grain: one row per (game, player, team) of the inner join.

    ``pair_rows`` = rows the literal join produces for the key.  ``grain``
    fixes what the downstream aggregates count:

    * "literal" (the reference): every joined row -- a tracking sample
      counts once per box-score row of its key and vice versa;
    * "pre_aggregated": every tracking sample and every box-score row once;
      row counts count (game, player, team) keys.

    The weights travel as columns (``w_track``, ``w_stats``, ``w_rows``), so
    the aggregating operators need no grain argument.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    t, s = side_summaries(tracking, stats, keys, team)
    return join_summaries(t, s, keys, grain)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Rows in a partition of ``dealt`` where their number is known.
DEALT_ROWS = 1 << 18


def dealt(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """The rows dealt by ``keys`` over all shuffle partitions, for joins and groupings by these keys.

    Adaptive execution merges partitions by their compressed bytes; summaries of ids and counts compress so well that a
    task then sorts and groups millions of rows at once.  A given number of partitions is left as it is.
    ``rows``: about how many there are, if known; so many partitions are taken that each gets ``DEALT_ROWS`` at most, and
    a task's memory doesn't grow with the table.
    """
    return df.repartition(max(shuffle_partitions(df), ceil(rows / DEALT_ROWS)), *keys)


def ranged(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """The rows dealt by ranges of ``keys``, at most ``DEALT_ROWS`` in a partition if their number is known, and not many fewer."""
    most = shuffle_partitions(df)
    return df.repartitionByRange(max(ceil(rows / DEALT_ROWS), min(most, ceil(4 * rows / DEALT_ROWS) or most)), *keys)


def weight(measure: str) -> Column:
    """How many aggregated rows each summed value of ``measure`` stands for."""
    return F.col("w_track") if measure in TRACK_MEASURES else F.col("w_stats")


def fan_sum(measure: str, alone: bool = False) -> Column:
    """sum(measure) over the joined rows; ``alone``: those of one key, without grouping."""
    x = weight(measure) * F.col(f"s_{measure}")
    return x if alone else F.sum(x)


def fan_count(measure: str, alone: bool = False) -> Column:
    """count(measure) over the joined rows; ``alone``: see ``fan_sum``."""
    x = weight(measure) * F.col(f"c_{measure}")
    return x if alone else F.sum(x)


def fan_avg(measure: str, alone: bool = False) -> Column:
    """avg(measure) over the joined rows (NULL when every value is NULL); ``alone``: see ``fan_sum``."""
    return F.try_divide(fan_sum(measure, alone), fan_count(measure, alone))


def fan_rows() -> Column:
    """count(*) / count(game_id) over the joined rows."""
    return F.sum("w_rows")


def fan_avg_of_game(col: str) -> Column:
    """avg of a per-game column (schedule side) over the joined rows."""
    x = F.col(col)
    return F.try_divide(F.sum(F.col("w_rows") * x), F.sum(F.when(x.isNotNull(), F.col("w_rows"))))


class HotKeys(NamedTuple):
    """Hashes of the keys that hold many of a table's rows, and how many parts each is split into."""

    hashes: tuple[int, ...]
    parts: int


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.02, partitions: int | None = None) -> HotKeys:
    """Keys with about ``share`` of the rows or more, by a heavy-hitter sketch of the key columns; one pass, started here.

    The sketch tracks four times as many items as can hold such a share, so none is missed; a key that is
    reported a little below it, or whose hash equals a hot one, is split without need, which changes no row.
    """
    known = df.where(_known(keys))
    tracked = max(100, ceil(4 / share))
    found = known.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {min(tracked, ceil(1 / share))}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    hot = [r for r in found["top"] or [] if r["count"] >= share * found["n"]]
    n = partitions or shuffle_partitions(df)
    # four parts for each task's share of the rows: parts fall to tasks by a hash, so some get more of them than others
    parts = max([2, *(ceil(4 * n * r["count"] / found["n"]) for r in hot)])
    return HotKeys(tuple(sorted(r["item"] for r in hot)), parts)


class Spread(NamedTuple):
    """Whether no key holds many of a table's rows, and how many rows there are."""

    even: bool
    rows: int


def spread(df: DataFrame, keys: Sequence[str], share: float = 0.02, few: int = 0) -> Spread:
    """Whether no key (NULLs are one) holds about ``share`` of the rows, by a heavy-hitter sketch; one pass, started here.
    ``few``: a key of fewer rows is none that holds many, whatever the share."""
    tracked = max(100, ceil(4 / share))
    found = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, 1, {tracked})").alias("top"), F.count("*").alias("n")).first()
    return Spread(all(r["count"] < max(share * found["n"], few) for r in found["top"] or []), found["n"])


def spread_out(df: DataFrame, keys: Sequence[str], share: float = 0.02) -> bool:
    """Whether no key holds about ``share`` of the rows (``spread``)."""
    return spread(df, keys, share).even


def sides_spread(tracking: DataFrame, stats: DataFrame, keys: Sequence[str] = ("game_id", "player_id")) -> Spread:
    """Whether J1's raw rows may be dealt by key (``side_summaries``), and the rows of the larger side."""
    t, s = spread(tracking, keys), spread(stats, keys)
    return Spread(t.even and s.even, max(t.rows, s.rows))


#: A game of fewer rows than this, or than this share of them, may go to one task whole.
GAME_ROWS, GAME_SHARE = 1 << 16, 0.0005


def games_spread(tracking: DataFrame, stats: DataFrame) -> Spread:
    """Whether J1's raw rows may be dealt by game alone (``scheduled_summaries``), and the rows of the larger side."""
    t, s = (spread(df, ["game_id"], GAME_SHARE, GAME_ROWS) for df in (tracking, stats))
    return Spread(t.even and s.even, max(t.rows, s.rows))


def sides_spread_out(tracking: DataFrame, stats: DataFrame, keys: Sequence[str] = ("game_id", "player_id")) -> bool:
    """Whether J1's raw rows may be dealt by key (``side_summaries``)."""
    return sides_spread(tracking, stats, keys).even


def _known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).isNotNull()
    return out


def split_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], hot: HotKeys | None, how: str = "left") -> DataFrame:
    """Equi-join (inner or left) of ``left`` with ``right`` on pairs of columns, hot keys of ``left`` split.

    Rows of a hot key are dealt over its parts by a hash of the whole row, and the right side's rows of that key are
    copied to each part; rows with a NULL key, which match nothing, are dealt alike.  All other rows move as in a
    plain join.  Without hot keys it is one.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins keep their rows under a split left side")
    cond = F.lit(True)
    for a, b in on:
        cond &= left[a] == right[b]
    if hot is None or not hot.hashes:
        return left.join(right, cond, how)
    kinds = {a: left.schema[a].dataType for a, _ in on}
    dealt = F.pmod(F.xxhash64(*left.columns, F.lit(1)), F.lit(hot.parts)).cast("int")
    is_hot = F.xxhash64(*[F.col(a) for a, _ in on]).isin(*hot.hashes) | ~_known([a for a, _ in on])
    salted = left.withColumn("_part", F.when(is_hot, dealt).otherwise(0))
    copied = F.xxhash64(*[F.col(b).cast(kinds[a]) for a, b in on]).isin(*hot.hashes)
    spread = right.withColumn("_copy", F.explode(F.when(copied, F.sequence(F.lit(0), F.lit(hot.parts - 1))).otherwise(F.array(F.lit(0)))))
    cond = salted["_part"] == spread["_copy"]
    for a, b in on:
        cond &= salted[a] == spread[b]
    return salted.join(spread, cond, how).drop("_part", "_copy")


SCHEDULE_CONTEXT = ("date", "back_to_back", "travel_distance_miles", "rest_days_since_last_game")


def schedule_context(keyed: DataFrame, schedule: DataFrame, key: str = "game_id", split: HotKeys | None = None, deal: bool = False,
                     rows: int = 0, extra: Sequence[str] = ()) -> DataFrame:
    """Left join of schedule context; a game without schedule keeps NULLs.

    No hint: the schedule side is broadcast only when its size estimate is
    under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run
    time); otherwise it is a shuffle join, which splits the hot games given in ``split``.
    ``deal``: for a grouping by game, which keeps adaptive execution from splitting the join anyway; ``rows``: see ``dealt``.
    ``extra``: more columns of the schedule.
    """
    sched = schedule.select(key, *SCHEDULE_CONTEXT, *extra)
    if split is None:
        return (dealt(keyed, key, rows=rows) if deal else keyed).join(sched, key, "left")
    return split_join(keyed, sched.withColumnRenamed(key, "_key"), [(key, "_key")], split).drop("_key")


#: Joined rows in a part of ``split_pairs``.
PART_PAIRS = 1 << 20
#: Parts of ``split_pairs`` at most; what is more goes to larger parts.
PARTS_MOST = 100_000


class PairParts(NamedTuple):
    """Into how many parts each key of a join is split, and how many partitions take them."""

    table: DataFrame
    partitions: int


def pair_parts(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], pairs: int | None = None) -> PairParts | None:
    """Keys whose join makes more than ``pairs`` rows, with the parts to split each into; None if the whole join makes no more.

    Counts per key of both sides are joined and written, a row per key; that job starts here.
    """
    size = pairs or PART_PAIRS
    names = [f"_k{k}" for k in range(len(on))]
    a = left.where(_known([x for x, _ in on])).groupBy(*[F.col(x).alias(n) for (x, _), n in zip(on, names)]).agg(F.count("*").alias("_left"))
    b = right.groupBy(*[F.col(y).cast(left.schema[x].dataType).alias(n) for (x, y), n in zip(on, names)]).agg(F.count("*").alias("_right"))
    made = materialize(a.join(b, names).withColumn("_rows", F.col("_left") * F.col("_right")), "pairs-of-keys")
    rows = made.agg(F.sum("_rows")).first()[0] or 0
    if rows <= size:
        return None
    size = max(size, ceil(rows / PARTS_MOST))
    table = made.select(*names, F.least(F.ceil(F.col("_rows") / size), F.col("_left")).cast("int").alias("_parts")).where("_parts > 1")
    return PairParts(table, max(shuffle_partitions(left), ceil(rows / size)))


def split_pairs(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], split: PairParts) -> DataFrame:
    """Left equi-join whose keys with many joined rows are split by ``pair_parts``.

    The left rows of a key are dealt over its parts by a hash of the whole row, and the right ones copied to each part: a task
    makes about ``pairs`` joined rows whatever the key holds.  Rows with a NULL key, which match nothing, are dealt alike;
    rows that are equal in all columns stay in one part.
    """
    kinds = {a: left.schema[a].dataType for a, _ in on}
    names = [f"_k{k}" for k in range(len(on))]

    def parts_of(df: DataFrame, cols: Sequence[Column]) -> DataFrame:
        same = F.lit(True)
        for n, c in zip(names, cols):
            same &= F.col(n) == c
        return df.join(F.broadcast(split.table), same, "left").drop(*names)

    n = F.when(_known([a for a, _ in on]), F.coalesce(F.col("_parts"), F.lit(1))).otherwise(F.lit(split.partitions))
    salted = (parts_of(left, [F.col(a) for a, _ in on])
                  .withColumn("_part", F.pmod(F.xxhash64(*left.columns, F.lit(1)), n).cast("int"))
                  .drop("_parts"))
    copied = parts_of(right, [F.col(b).cast(kinds[a]) for a, b in on])
    copied = copied.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    for k, (a, b) in enumerate(on):
        copied = copied.withColumn(f"_r{k}", F.col(b).cast(kinds[a]))
    salted = salted.repartition(split.partitions, *[a for a, _ in on], "_part")
    copied = copied.repartition(split.partitions, *[f"_r{k}" for k in range(len(on))], "_copy")
    cond = salted["_part"] == copied["_copy"]
    for k, (a, _) in enumerate(on):
        cond &= salted[a] == copied[f"_r{k}"]
    return salted.join(copied, cond, "left").drop("_part", "_copy", *[f"_r{k}" for k in range(len(on))])


def join_training_by_date(sessions: DataFrame, schedule: DataFrame, date: str = "date") -> DataFrame:
    """J2 as a fan-out diagnostic: rows the date-only left join would give, per date.

    joined_rows = sessions x max(games, 1); computed from two counts per
    date instead of building the multiplied rows.
    """
    s = sessions.groupBy(date).agg(F.count(F.lit(1)).alias("sessions"))
    g = schedule.filter(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("games"))
    j = s.join(g, date, "left").fillna({"games": 0})
    return j.select(date, "sessions", "games",
                    (F.col("sessions") * F.greatest(F.col("games"), F.lit(1))).alias("joined_rows"))


def attach_team(sessions: DataFrame, tracking: DataFrame, player: str = "player_id",
                team: str = "team_id") -> DataFrame:
    """Add team via the distinct (player, team) bridge; two teams duplicate a session.

    The bridge is per player: broadcast where its true size is under the limit, else a
    shuffle join whose hot players adaptive execution splits.
    """
    bridge = tracking.select(player, team).distinct()
    return sessions.join(bridge, player, "left")


def join_schedule(sessions: DataFrame, schedule: DataFrame, date: str = "date", team: str = "team_id",
                  sides: Sequence[str] = ("home_team", "away_team"), split: HotKeys | None = None,
                  pairs: int | None = None) -> DataFrame:
    """Left join on ``date = date AND (team = home OR team = away)``.

    The OR becomes an equi-join: each game is listed once per distinct team
    it involves (``array_distinct`` keeps a home = away game single), and the
    sessions join on (date, team).  Same rows as the OR join, but hashed on
    both keys instead of date alone.  ``split``: the sessions' hot (date, team) keys (``hot_keys``).
    ``pairs``: a (date, team) that makes more joined rows is split into parts of so many, and partitions follow the joined rows (``pair_parts``, a job of its own).
    """
    games = _games_of_teams(schedule, date, sides)
    on = [(date, "_date"), (team, "_team")]
    if pairs is not None:
        parts = pair_parts(sessions, games, on, pairs)
        if parts is not None:
            return split_pairs(sessions, games, on, parts).drop("_date", "_team")
    return split_join(sessions, games, on, split).drop("_date", "_team")


def _games_of_teams(schedule: DataFrame, date: str, sides: Sequence[str]) -> DataFrame:
    """Each game once per distinct team (``_team``), its date as ``_date``."""
    games = schedule.withColumn("_team", F.explode(F.array_distinct(F.array(*[F.col(s) for s in sides]))))
    return games.withColumnRenamed(date, "_date")


def schedule_weights(sessions: DataFrame, schedule: DataFrame, measure: str = "travel_distance_miles", date: str = "date",
                     team: str = "team_id", sides: Sequence[str] = ("home_team", "away_team")) -> DataFrame:
    """J4 summed up per session, for groupings of its rows: ``w_rows`` is how many rows J4 has for the session, ``measure`` the
    mean of that column over them and ``w_<measure>`` how many have it.  Grows with the sessions, J4 with sessions times games."""
    games = _games_of_teams(schedule, date, sides).groupBy("_date", "_team").agg(
        F.count(F.lit(1)).alias("w_rows"), F.avg(measure).alias(measure), F.count(measure).alias(f"w_{measure}"))
    j = sessions.join(games, (sessions[date] == games["_date"]) & (sessions[team] == games["_team"]), "left").drop("_date", "_team")
    return j.fillna({"w_rows": 1, f"w_{measure}": 0})


def coverage_gaps(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in ``expected`` with no row in ``actual``, with their row counts."""
    exp = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected_rows"))
    have = actual.select(*keys).distinct()
    return exp.join(have, list(keys), "left_anti")


def horizon_label(snapshots: DataFrame, events: DataFrame, key: str = "player_id",
                  snap_date: str = "date", event_date: str = "injury_date",
                  days: int = 7, label: str = "injury_within_7_days") -> DataFrame:
    """label = 1 when some event of the same key falls 0..days after the snapshot date.

    Dates are cut into buckets of ``days + 1`` days, so such an event lies in the snapshot's bucket or the next.  In
    its own bucket the last event tells (any from the snapshot on is near enough), in the next one the first.  So
    each event is summed up in two buckets, whatever ``days`` is, and a snapshot joins one row of its
    (key, bucket): no expansion by days and no pairs.
    """
    def bucket(date: str) -> Column:
        return F.floor(F.unix_date(date) / F.lit(days + 1))

    lands = F.inline(F.array(
        F.struct(bucket(event_date).alias("_bucket"), F.col(event_date).alias("_own"), F.lit(None).cast("date").alias("_next")),
        F.struct((bucket(event_date) - 1).alias("_bucket"), F.lit(None).cast("date").alias("_own"), F.col(event_date).alias("_next"))))
    near = (events.where(F.col(event_date).isNotNull()).select(F.col(key).alias("_key"), lands)
            .groupBy("_key", "_bucket").agg(F.max("_own").alias("_last"), F.min("_next").alias("_first")))
    hit = (F.col("_last") >= F.col(snap_date)) | (F.col("_first") <= F.date_add(snap_date, days))
    j = snapshots.withColumn("_at", bucket(snap_date)).join(near, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_bucket")), "left")
    return j.select(*snapshots.columns, F.when(hit, 1).otherwise(0).alias(label))
