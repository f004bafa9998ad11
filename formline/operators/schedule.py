"""Schedules: derive, double, join with facts, split at a cutoff, fill with
rosters, and pick dates and next games."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.functions.dates import as_day, day_range
from formline.functions.numbers import as_column
from formline.operators.joins import join_apart_from_nulls, left_join_many
from formline.operators.lastknown import earliest_per_key
from formline.operators.shape import side_pivot, union_all
from formline.session import reliable_checkpoint

REGULAR_AND_PLAYOFF = (2, 3)  # fixed values: game types that count
LARGE_LIST = 500


DEFAULT_START = "7:00 PM Default"  # fixed value: what stands for a time that isn't known


def with_day_and_times(df: DataFrame, date: str, times: Sequence[str] = ("EASTERN", "LOCAL"), day: str = "DAY", default: str = DEFAULT_START) -> DataFrame:
    """A schedule with the short name of the day, and a default where a start time is null or its column missing."""
    known = {c: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default) for c in times}
    return df.withColumns({day: F.date_format(date, "E"), **known})


def keep_game_types(df: DataFrame, column: str = "gameType", types: Sequence[int] = REGULAR_AND_PLAYOFF) -> DataFrame:
    return df.filter(F.col(column).isin(*types))


def schedule_from_facts(df: DataFrame, keys: Sequence[str], side: str, team: str, home="HOME", away="AWAY") -> DataFrame:
    """One row per game with its home and away team, from per-team facts."""
    return side_pivot(df, keys, side, team, {"HOME": home, "AWAY": away})


def combine_schedules(history: DataFrame, future: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Union of both, one row per key; the played row wins over the planned."""
    both = union_all(history.withColumn("_source", F.lit(0)), future.withColumn("_source", F.lit(1)))
    return earliest_per_key(both, keys, ["_source", *order]).drop("_source")


def expand_schedule(df: DataFrame, home: str, away: str, team: str = "team", opponent: str | None = None, side: str | None = None) -> DataFrame:
    """Two rows per game, one per team, from a single scan."""
    views = F.array(
        F.struct(F.col(home).alias("t"), F.col(away).alias("o"), F.lit("HOME").alias("s")),
        F.struct(F.col(away).alias("t"), F.col(home).alias("o"), F.lit("AWAY").alias("s")),
    )
    chosen = [F.col("_v.t").alias(team)]
    if opponent:
        chosen.append(F.col("_v.o").alias(opponent))
    if side:
        chosen.append(F.col("_v.s").alias(side))
    return df.withColumn("_v", F.explode(views)).select(*df.columns, *chosen)


def home_and_away(team: str, opponent: str, side: str) -> tuple[Column, Column]:
    is_home = F.col(side) == "HOME"
    return (
        F.when(is_home, F.col(team)).otherwise(F.col(opponent)),
        F.when(is_home, F.col(opponent)).otherwise(F.col(team)),
    )


def join_schedule(
    schedule: DataFrame, games: DataFrame, on: Sequence[str], how: str = "full_outer", order: Sequence[str] = ()
) -> DataFrame:
    """Schedule with the facts of its games. ``order`` makes the fact side one
    row per key first, so that the join cannot multiply rows."""
    facts = earliest_per_key(games, on, order) if order else games
    return join_apart_from_nulls(schedule, facts, on, how)


def split_played(df: DataFrame, date: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows up to the cutoff date, rows after it)."""
    return df.filter(day_range(df, date, last=cutoff)), df.filter(day_range(df, date, first=as_day(cutoff, 1)))


def null_id_after(df: DataFrame, game: str, date: str, cutoff) -> DataFrame:
    """Games after the cutoff are upcoming: their id becomes null."""
    value = F.when(F.to_date(F.col(date)) <= F.lit(cutoff).cast("date"), F.col(game))
    return df.withColumn(game, value)


def keep_listed(df: DataFrame, columns: Sequence[str], allowed: Sequence | DataFrame) -> DataFrame:
    """Rows whose every listed column is an allowed code: a literal list, or a
    one-column table that is joined (long lists become such a table)."""
    if not isinstance(allowed, DataFrame) and len(allowed) > LARGE_LIST:
        allowed = df.sparkSession.createDataFrame([(v,) for v in allowed], [columns[0]]).distinct()
    for c in columns:
        if isinstance(allowed, DataFrame):
            codes = allowed.select(F.col(allowed.columns[0]).alias("_code")).distinct()
            df = df.join(codes, F.col(c) == F.col("_code"), "left_semi")
        else:
            df = df.filter(F.col(c).isin(*allowed))
    return df


def drop_before_season_start(df: DataFrame, season: str, date: str, starts: dict, upcoming: Column) -> DataFrame:
    """Drops rows dated before their season began; upcoming rows stay."""
    start = F.lit(None).cast("date")
    for code, first in starts.items():
        start = F.when(F.col(season) == code, F.lit(first).cast("date")).otherwise(start)
    return df.filter(upcoming | start.isNull() | (F.to_date(F.col(date)) >= start))


def roster_projection(roster: DataFrame, season: str, last, current) -> DataFrame:
    """Last season's roster relabelled as current, with the actual rosters."""
    projected = roster.filter(F.col(season) == last).withColumn(season, F.lit(current).cast(roster.schema[season].dataType))
    return union_all(roster, projected.select(*roster.columns)).distinct()


def roster_fill(
    df: DataFrame, roster: DataFrame, on: Sequence[str], columns: Sequence[str], game: str, player: str
) -> DataFrame:
    """Upcoming rows without a player get one row per roster member; rows that
    were played never meet the roster. Roster columns fill nulls only."""
    needs = F.col(game).isNull() & F.col(player).isNull()
    members = roster.select(*on, *[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    filled = left_join_many(df.filter(needs), members, on)
    filled = filled.select(
        *[F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
    return df.filter(~needs & F.col(player).isNotNull()).unionByName(filled)


def next_upcoming_only(df: DataFrame, entity: Sequence[str], upcoming: Column, order: Sequence[str]) -> DataFrame:
    """All played rows, and for each entity its earliest upcoming row."""
    soonest = earliest_per_key(df.filter(upcoming), entity, order).select(*df.columns)
    return df.filter(~upcoming).unionByName(soonest)


def next_game_per_member(
    upcoming: DataFrame, roster: DataFrame, on: Sequence[str], player: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The next upcoming game of every roster member.

    The schedule is cut to each team's earliest game before the roster joins
    it, so the result grows with the roster and not with games times members;
    a member of several teams then keeps the earliest of those games.
    """
    soonest = earliest_per_key(upcoming, on, order)
    joined = soonest.join(roster.distinct(), list(on), "inner")
    return earliest_per_key(joined, player, order)


def recent_as_upcoming(df: DataFrame, game: str, order: Sequence[Column], upcoming: Column, rows: int = 35) -> DataFrame:
    """When nothing is upcoming, the most recent played rows stand in with a
    null id; otherwise the upcoming rows."""
    waiting = df.filter(upcoming)
    if not waiting.isEmpty():
        return waiting
    recent = df.filter(~upcoming).orderBy(*order).limit(rows)
    return recent.withColumn(game, F.lit(None).cast(df.schema[game].dataType))


SLATE_BLOCK = 1_000_000


def first_games_of_slate(df: DataFrame, home: str, away: str, order: Sequence[str], block: int = SLATE_BLOCK) -> DataFrame:
    """Games taken greedily in ``order``, then home and away: a game is left out
    when one of its teams already has an earlier game of the slate.

    Goes by blocks: one task takes the first ``block`` games left, of which it only
    sees order and teams, one after another; then all games of the teams taken go,
    and with them every game of the block. So a chain of games, each sharing a team
    with the next, needs no round for each link. Blocks are few: after the first,
    few teams are left. Rows without a team, and repeats of a game in order and
    teams, are left out.
    """
    rank = list(dict.fromkeys([*order, home, away]))
    left = reliable_checkpoint(df.filter(F.col(home).isNotNull() & F.col(away).isNotNull()).dropDuplicates(rank))
    sides, taken = (rank.index(home), rank.index(away)), None
    keys = left.select(*rank).schema

    def take(batches):
        import pyarrow as pa

        busy: set = set()
        for batch in batches:
            teams = zip(*(batch.column(i).to_pylist() for i in sides), strict=True)
            chosen = []
            for h, a in teams:
                chosen.append(h not in busy and a not in busy)
                if chosen[-1]:
                    busy.update((h, a))
            yield batch.filter(pa.array(chosen, pa.bool_()))

    while True:
        many = left.count()
        first = left.select(*rank).orderBy(*rank)
        first = first.coalesce(1).sortWithinPartitions(*rank) if many <= block else first.limit(block).coalesce(1).sortWithinPartitions(*rank)
        won = reliable_checkpoint(first.mapInArrow(take, keys))
        kept = left
        marks = won.select(*[F.col(c).alias(f"_w_{c}") for c in rank])
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in rank])
        kept = kept.join(marks, match, "left_semi")
        taken = kept if taken is None else taken.unionByName(kept)
        if many <= block:
            return taken
        teams = won.select(F.explode(F.array(home, away)).alias("_t")).distinct()
        for side in (home, away):
            left = left.join(teams, F.col(side) == F.col("_t"), "left_anti")
        left = reliable_checkpoint(left)


def best_available_date(df: DataFrame, date: str, requested, lookback: int = 7) -> DataFrame:
    """Rows of the requested date or, when it has none, of the nearest earlier
    date within ``lookback`` days."""
    near = df.filter(day_range(df, date, as_day(requested, -lookback), requested))
    day = F.to_date(F.col(date))
    return near.filter(day == near.agg(F.max(day)).scalar())


def next_date_after(df: DataFrame, date: str, after, condition: Column | None = None) -> DataFrame:
    """Rows of the earliest date after ``after`` among rows that meet the
    condition."""
    later = df.filter(day_range(df, date, first=as_day(after, 1)))
    rows = later if condition is None else later.filter(condition)
    day = F.to_date(F.col(date))
    return rows.filter(day == rows.agg(F.min(day)).scalar())


def latest_date_plus(df: DataFrame, entity: Sequence[str], date: str, days: int = 2, alias: str = "next_date") -> DataFrame:
    return df.groupBy(*entity).agg(F.date_add(F.max(F.to_date(F.col(date))), days).alias(alias))


def first_open_game(df: DataFrame, pair: Sequence[str], value: Column | str, order: Sequence[str]) -> DataFrame:
    """First row per pair whose value is still null."""
    return earliest_per_key(df.filter(as_column(value).isNull()), pair, order).select(*df.columns)
