"""Per-game and rolling workload kept up to date by increments (S6): new rows rebuild only the partitions they reach.

What an increment brings is reduced to J1's key summaries, written to a folder of its own and then entered in a list that
is replaced in one step.  Summaries of several increments merge exactly, so raw rows are never read again, and a game may
come in pieces (box scores before tracking, late samples, a late schedule row).  From them

* ``player_game_workload`` (partitions of a game-id hash) is rebuilt for the parts that hold a game of the increment (other
  games' rows there are written again as they are, if all increments before went through);
* ``rolling_workload`` (a partition per team) is rebuilt for the teams of the players of these games, since a player's new
  game moves the frames of later ones.

Raw rows, and later their summaries, are dealt by game so that a task holds games of one part: J1, J5 and A1 then follow, and
the parts are written, without moving a row again.  W1's rows are dealt by ranges of teams, as they are written.

Both are written with dynamic partition overwrite; all other partitions keep their files.  Both follow from the listed summaries
alone, so an increment that died anywhere is simply added again under the same id.  One increment is added at a time.

Defined cases: an increment without rows changes nothing; rows without a game id are a game of their own, which joins
nothing; an id that was merged into a compacted folder is refused; a team id that is an empty text is read back as NULL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from courtload.operators import joins, workload
from courtload.session import materialize, read_text, remove_path, replace_text, run_intermediates
from courtload.sources.adapters import Domain
from courtload.sources.files import publish, read_optional

PART = "game_part"
PARTS = 64
LIST = "_increments"
HASH = "hash"
FOLDER = "increment"
COMPRESSION = "zstd"
#: Games of an increment that the other games of their parts are kept beside, at most; with more whole parts are made again.
REACHED_MOST = 1_000_000
TRACK_KEYS = ("game_id", "player_id", "team_id")
STATS_KEYS = ("game_id", "player_id")
SCHEDULE = ("game_id", "date", "back_to_back", "travel_distance_miles", "rest_days_since_last_game")
KINDS = ("tracking", "stats", "schedule")


def _merged_spread(parts: Column) -> Column:
    """Squared deviations of several groups from their common mean, from (count, sum, deviations) of each."""
    filled = F.filter(parts, lambda p: p["c"] > 0)

    def add(a: Column, p: Column) -> Column:
        apart = F.coalesce(a["s"] / F.nullif(a["c"], F.lit(0)) - p["s"] / p["c"], F.lit(0.0))
        return F.struct((a["c"] + p["c"]).alias("c"), (a["s"] + p["s"]).alias("s"),
                        (a["m2"] + p["m2"] + apart * apart * a["c"] * p["c"] / (a["c"] + p["c"])).alias("m2"))
    zero = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0.0).alias("s"), F.lit(0.0).alias("m2"))
    return F.when(F.size(filled) > 0, F.aggregate(filled, zero, add)["m2"])


def merge_summaries(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from summaries of disjoint rows: counts and sums add up, spreads are combined about the common mean.

    A key has at most a row for each increment since the last compaction.
    """
    aggs = []
    for name in (c for c in rows.columns if c not in keys):
        measure = name.removeprefix("m2_")
        if name == measure:
            aggs.append(F.sum(name).cast(rows.schema[name].dataType).alias(name))
        else:
            group = F.struct(F.col(f"c_{measure}").alias("c"), F.col(f"s_{measure}").cast("double").alias("s"), F.col(name).alias("m2"))
            aggs.append(_merged_spread(F.collect_list(group)).alias(name))
    return rows.groupBy(*keys).agg(*aggs)


def _among(rows: DataFrame, chosen: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """The rows whose value of ``column`` is among ``chosen`` (NULL is a value), or with "left_anti" the others."""
    other = chosen.select(F.col(column).alias("_chosen")).distinct()
    return rows.join(other, F.col(column).eqNullSafe(F.col("_chosen")), how)


class Increments:
    """The tables under ``root`` and the increments they hold."""

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts

    # --- the list of increments -----------------------------------------------------
    def listed(self) -> list[dict]:
        """Folders in use, oldest first, each with the ids of the increments in it."""
        found = [json.loads(line) for line in (read_text(self.spark, f"{self.root}/{LIST}") or "").splitlines()]
        if any(f.get("by") != HASH for f in found):
            raise ValueError(f"{self.root} holds parts by another hash of the game: add its increments again in a new folder")
        return found

    def _list(self, folders: list[dict]) -> None:
        replace_text(self.spark, f"{self.root}/{LIST}", "\n".join(json.dumps(f) for f in folders))

    @property
    def _part(self) -> Column:
        """A game's part.  It is taken from the hash that Spark deals rows by, so that of a multiple of ``parts`` partitions
        (``_dealt``) each holds games of one part; were the two hashes to differ, there would only be more files."""
        return F.pmod(F.hash("game_id"), F.lit(self.parts)).cast("int")

    def _dealt(self, df: DataFrame, rows: int) -> DataFrame:
        """The rows dealt by game, at most ``joins.DEALT_ROWS`` in a partition, games of one part in each."""
        return df.repartition(self.parts * max(1, ceil(rows / joins.DEALT_ROWS / self.parts)), "game_id")

    def _store(self, ids: list[str], tables: dict[str, DataFrame], rows: int, together: bool) -> dict:
        name = f"{FOLDER}={uuid.uuid4().hex[:12]}"
        for kind in KINDS:
            publish(tables[kind].withColumn(PART, self._part), f"{self._home(kind)}/{name}", [PART], cluster_by=["game_id"], compression=COMPRESSION,
                    together=together)
        schemas = {kind: tables[kind].schema.json() for kind in KINDS}
        return {"folder": name, "ids": ids, "schemas": schemas, "rows": rows, "by": HASH, "done": False}

    def _read(self, folders: list[dict], kind: str) -> DataFrame:
        made = StructType.fromJson(json.loads(folders[-1]["schemas"][kind]))
        with_parts = StructType([*made.fields, StructField(FOLDER, StringType()), StructField(PART, IntegerType())])
        home = self._home(kind)
        return (self.spark.read.schema(with_parts).option("basePath", home)
                .parquet(*(f"{home}/{f['folder']}" for f in folders)).drop(FOLDER))

    def _home(self, kind: str) -> str:
        return f"{self.root}/summaries/{kind}"

    def _remove(self, folders: list[dict]) -> None:
        for f in folders:
            for kind in KINDS:
                remove_path(self.spark, f"{self._home(kind)}/{f['folder']}")

    # --- derived tables -----------------------------------------------------------------
    def _keyed(self, folders: list[dict], parts: Sequence[int], only: DataFrame | None = None) -> DataFrame:
        """J1 and J5 of the games in ``parts``, or of those of them among ``only``; plan it under ``joins.dealt_by_part``."""
        rows = sum(f["rows"] for f in folders) if only is None else 0

        def of(kind: str) -> DataFrame:
            found = self._read(folders, kind).where(F.col(PART).isin(*parts)).drop(PART)
            # dealt by game once, for the merge and both joins
            return self._dealt(found if only is None else _among(found, only, "game_id"), rows)
        t = merge_summaries(of("tracking"), TRACK_KEYS)
        s = merge_summaries(of("stats"), STATS_KEYS)
        return joins.schedule_context(joins.join_summaries(t, s, deal=False), of("schedule").where("game_id IS NOT NULL"))

    def _put(self, name: str, rows: DataFrame, partition: str, cluster_by: Sequence[str]) -> DataFrame:
        """Replace the partitions that ``rows`` holds; the whole table."""
        replace_text(self.spark, f"{self.root}/_{name}.schema", rows.schema.json())
        publish(rows, f"{self.root}/{name}", [partition], cluster_by=cluster_by, dynamic=True, compression=COMPRESSION, together=True)
        return self._table(name)

    def _table(self, name: str) -> DataFrame:
        shape = read_text(self.spark, f"{self.root}/_{name}.schema")
        if shape is None:
            raise FileNotFoundError(f"{self.root}: no rows were added yet")
        schema = StructType.fromJson(json.loads(shape))
        return read_optional(self.spark, f"{self.root}/{name}", schema).select(*schema.names)

    def player_games(self) -> DataFrame:
        return self._table("player_game_workload")

    def rolling(self) -> DataFrame:
        return self._table("rolling_workload")

    # --- changes ------------------------------------------------------------------------
    def add(self, increment: str, domain: Domain) -> None:
        """Add rows of tracking, box scores and schedule, and rebuild the partitions that they reach."""
        before = [f for f in self.listed() if f["ids"] != [increment]]
        if any(increment in f["ids"] for f in before):
            raise ValueError(f"increment {increment} is part of a compacted folder already")
        # a crowded game is summed up before it is dealt, and its summaries are dealt as they are written
        even, rows = joins.games_spread(domain.tracking, domain.stats)
        raw = [self._dealt(df, rows) if even else df for df in (domain.tracking, domain.stats)]
        t, s = joins.side_summaries(*raw)
        schedule = domain.schedule.select(*SCHEDULE)
        new = self._store([increment], {"tracking": t, "stats": s, "schedule": self._dealt(schedule, rows) if even else schedule}, rows, even)
        again = [f for f in self.listed() if f["ids"] == [increment]]
        # the parts of an earlier try are rebuilt as well: it may have brought other rows
        reached = self._reached([new, *again])
        folders = [*before, new]
        self._list(folders)
        with run_intermediates(self.spark, "increment"):
            reached = materialize(reached, "reached-games")
            parts = sorted(r[PART] for r in reached.select(PART).distinct().collect())   # at most ``parts`` numbers
            if parts:
                self._rebuild(folders, reached, parts, keep=bool(before) and all(f.get("done") for f in before))
        self._list([*before, {**new, "done": True}])
        self._remove(again)

    def _reached(self, folders: list[dict]) -> DataFrame:
        games = [self._read(folders, kind).select("game_id", PART) for kind in KINDS]
        return games[0].unionByName(games[1]).unionByName(games[2]).distinct()

    def _rebuild(self, folders: list[dict], reached: DataFrame, parts: Sequence[int], keep: bool = False) -> None:
        """``keep``: all increments before went through; the rows of games that this one doesn't reach are then written again as
        they are, and not made again from the summaries."""
        keep = keep and reached.count() <= REACHED_MOST and read_text(self.spark, f"{self.root}/_player_game_workload.schema") is not None
        with joins.dealt_by_part(self.spark):
            games = workload.player_game_workload(self._keyed(folders, parts, reached if keep else None)).withColumn(PART, self._part)
            if keep:
                here = self.player_games().where(F.col(PART).isin(*parts))
                games = _among(here, reached, "game_id", "left_anti").unionByName(games)
            table = self._put("player_game_workload", games, PART, ["player_id", "game_id"])
        pgw, here = table.drop(PART), table.where(F.col(PART).isin(*parts)).drop(PART)
        teams = materialize(_among(pgw, _among(here, reached, "game_id"), "player_id").select("team_id").distinct(), "reached-teams")
        # ids alone, written: small enough to be broadcast, they move no rows of the table
        players = materialize(_among(pgw, teams, "team_id").select("player_id").distinct(), "involved-players")
        involved = _among(pgw, players, "player_id")
        # W1 deals the rows by ranges of a team of each player, as they are written
        first = materialize(workload.first_teams(involved), "first-teams")
        rolled = _among(workload.rolling_workload(involved, rows=involved.count(), teams=first), teams, "team_id")
        self._put("rolling_workload", rolled, "team_id", ["player_id", "date", "game_id"])

    def compact(self) -> None:
        """Merge the summaries of all increments into one folder; derived tables stay as they are."""
        folders = self.listed()
        if len(folders) < 2:
            return
        merge: dict[str, Callable[[DataFrame], DataFrame]] = {
            "tracking": lambda d: merge_summaries(d, TRACK_KEYS), "stats": lambda d: merge_summaries(d, STATS_KEYS), "schedule": lambda d: d}
        rows = sum(f["rows"] for f in folders)
        merged = {k: m(self._dealt(self._read(folders, k).drop(PART), rows)) for k, m in merge.items()}
        one = self._store([i for f in folders for i in f["ids"]], merged, rows, True)
        self._list([{**one, "done": all(f.get("done") for f in folders)}])
        self._remove(folders)
