"""Column shaping: slices, prefixes, pivots, unpivots and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.functions.dates import parse_date
from formline.functions.numbers import is_count_name, zero_if_null
from formline.functions.text import clean_id


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def pick_columns(
    df: DataFrame, keep: Sequence[str] = (), starts: Sequence[str] = (), contains: Sequence[str] = ()
) -> DataFrame:
    """Columns that are listed, start with one of ``starts`` or hold one of
    ``contains``, in table order."""
    chosen = [
        c for c in df.columns if c in keep or c.startswith(tuple(starts)) or any(part in c for part in contains)
    ]
    return df.select(*chosen)


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[c for c in dict.fromkeys([*first, *df.columns]) if c in present])


def situation_slice(
    df: DataFrame,
    columns: Sequence[str],
    prefix: str,
    value: str,
    situation: str = "situation",
    keys: Sequence[str] = (),
    date: str | None = None,
    strip: str = "I_F_",
    ids: Sequence[str] = (),
    season: tuple[str, Sequence] | None = None,
) -> DataFrame:
    """Rows of one situation, key columns kept, the others without ``strip``
    and with ``prefix``; dates normalized, ids cleaned, seasons restricted."""
    rows = df.filter(F.col(situation) == value)
    if season:
        rows = rows.filter(F.col(season[0]).isin(*season[1]))

    def column(c: str) -> Column:
        if c == date:
            return parse_date(c).alias(c)
        if c in ids:
            return clean_id(c).alias(c)
        if c in keys:
            return F.col(c)
        return F.col(c).alias(prefix + c.replace(strip, ""))

    return rows.select(*[column(c) for c in columns])


def pivot_situation(
    df: DataFrame,
    keys: Sequence[str],
    situation: str,
    mapping: dict[str, str],
    measures: Sequence[str],
    prefix: str = "",
    base: str | None = None,
    aggregate=F.max,
) -> DataFrame:
    """One row per key with ``<prefix><label>_<measure>`` for every situation
    of ``mapping`` (value -> label): one aggregation instead of a self join per
    situation. ``base`` keeps only keys that have that situation."""
    columns = [
        aggregate(F.when(F.col(situation) == value, F.col(m))).alias(f"{prefix}{label}_{m}")
        for value, label in mapping.items()
        for m in measures
    ]
    if base is None:
        return df.groupBy(*keys).agg(*columns)
    has_base = F.max((F.col(situation) == base).cast("int")).alias("_base")
    return df.groupBy(*keys).agg(*columns, has_base).filter("_base = 1").drop("_base")


def all_plus_each(df: DataFrame, keys: Sequence[str], situation: str, aggregates: Sequence[Column], total="all") -> DataFrame:
    """Aggregates per situation and over all of them, by grouping sets."""
    rolled = df.groupingSets(
        [[*keys, situation], [*keys]], *keys, situation
    ).agg(*aggregates, F.grouping(situation).alias("_total"))
    named = F.when(F.col("_total") == 1, F.lit(total)).otherwise(F.col(situation))
    return rolled.withColumn(situation, named).drop("_total")


def sums_plus_each(df: DataFrame, keys: Sequence[str], situation: str, measures: Sequence[str], total="all") -> DataFrame:
    """Sums per situation and over all of them. Rows are summed per situation
    first; only those sums, at most a row for each situation of a key, are told
    twice, where ``all_plus_each`` doubles every row."""
    each = df.groupBy(*keys, situation).agg(*[F.sum(m).alias(m) for m in measures])
    both = each.withColumn("_s", F.explode(F.array(F.struct(F.col(situation).alias("s"), F.lit(False).alias("all")), F.struct(F.lit(total).alias("s"), F.lit(True).alias("all")))))
    summed = both.drop(situation).groupBy(*keys, "_s").agg(*[F.sum(m).alias(m) for m in measures])
    return summed.select(*keys, F.col("_s.s").alias(situation), *measures)


def season_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], game: str | None = None, prefix: str = "") -> DataFrame:
    """Summed measures per key, e.g. per player, team, season and situation;
    with ``game`` also the number of distinct games, counted by grouping twice."""
    if game is None:
        return df.groupBy(*keys).agg(*[F.sum(m).alias(prefix + m) for m in measures])
    per_game = df.groupBy(*keys, game).agg(*[F.sum(m).alias(m) for m in measures])
    return per_game.groupBy(*keys).agg(
        *[F.sum(m).alias(prefix + m) for m in measures], F.count(game).alias("games_played")
    )


def side_pivot(df: DataFrame, keys: Sequence[str], side: str, value: str, sides: dict[str, str]) -> DataFrame:
    """One column per side, e.g. HOME and AWAY team of a game."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(side) == s, F.col(value))).alias(a) for s, a in sides.items()])


def unpivot_points(df: DataFrame, keys: Sequence[str], points: dict[str, str], label="label", value="value") -> DataFrame:
    """Wide metrics to labelled points (column -> label)."""
    doubled = df.select(*keys, *[F.col(c).cast("double").alias(text) for c, text in points.items()])
    return doubled.unpivot(list(keys), list(points.values()), label, value)


def zero_fill_counts(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Nulls of count columns become 0; ranks and percentages keep theirs."""
    return df.select(
        *[
            zero_if_null(c).alias(c) if c.startswith(tuple(prefixes)) and is_count_name(c) else F.col(c)
            for c in df.columns
        ]
    )


def typed_nulls(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns])


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_position(*frames: DataFrame) -> DataFrame:
    """Union by place of the columns, under the names of the first frame; their
    number must agree."""
    if len({len(f.columns) for f in frames}) > 1:
        raise ValueError("the frames differ in their number of columns")
    return reduce(DataFrame.union, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def swap_view(df: DataFrame, is_other_side: Column, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Exchange paired columns on rows told from the other side."""
    exchanged = {}
    for a, b in pairs:
        exchanged[a] = F.when(is_other_side, F.col(b)).otherwise(F.col(a))
        exchanged[b] = F.when(is_other_side, F.col(a)).otherwise(F.col(b))
    return df.select(*[exchanged[c].alias(c) if c in exchanged else F.col(c) for c in df.columns])
