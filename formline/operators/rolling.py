"""Rolling form: previous known values, last-n means, running totals, medians
and hit rates per entity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.functions.numbers import at_least, ratio, round_half_up
from formline.operators.joins import broadcast_if_small, null_safe_join
from formline.operators.ordered import Framed, Running, hot_groups, over_ordered, split_hot
from formline.session import reliable_checkpoint

#: One over the error of the ranks that bracket the medians of crowded groups.
MEDIAN_ACCURACY = 10_000


def _mean_frame(name: str, n: int, played: Column | None, include_current: str) -> Callable:
    def leak_free(w):
        return F.avg(name).over(w.rowsBetween(-n, -1))

    def inclusive(w):
        return F.avg(name).over(w.rowsBetween(-(n - 1), 0))

    if include_current == "never":
        return leak_free
    if include_current == "always":
        return inclusive
    if include_current == "played" and played is not None:
        return lambda w: F.when(played, inclusive(w)).otherwise(leak_free(w))
    raise ValueError("include_current is never, always, or played together with a played condition")


def rolling_form(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence,
    measures: Sequence[str],
    windows: Sequence[int] = (3, 7),
    played: Column | None = None,
    include_current: str = "never",
    prefix: str = "",
    digits: int = 2,
    zero_fill: Callable[[str], bool] | None = None,
    extra: Sequence[Running | Framed] = (),
    hot="measure",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Append ``previous_<m>`` (last known value strictly before the row) and
    ``average_<m>_last_<n>_games`` for every measure.

    ``include_current`` picks the frame of the means: ``never`` looks at earlier
    rows only, ``always`` includes the row itself, ``played`` includes it for
    rows that meet ``played`` and leaves it out for the others. ``zero_fill``
    gets the output name and says whether its nulls become zero. ``extra``
    outputs (counts, flags) over the same order ride along in the same pass.
    """
    outputs, named = [], []
    for i, m in enumerate(measures):
        outputs.append(Running(f"_p{i}", F.col(m), "last", strict=True))
        named.append((f"_p{i}", f"{prefix}previous_{m}"))
        for n in windows:
            outputs.append(Framed(f"_a{i}_{n}", _mean_frame(m, n, played, include_current), back=n))
            named.append((f"_a{i}_{n}", f"{prefix}average_{m}_last_{n}_games"))
    done = over_ordered(df, entity, order, [*outputs, *extra], hot=hot, bounded_by=bounded_by)

    def final(raw, name):
        value = round_half_up(raw, digits)
        return F.coalesce(value, F.lit(0.0)) if zero_fill and zero_fill(name) else value

    return done.select(
        *df.columns, *[final(raw, name).alias(name) for raw, name in named], *[o.alias for o in extra]
    )


def keep_rank_nulls(name: str) -> bool:
    """Zero-fill rule of the form table: previous ranks keep their nulls."""
    return not ("previous_" in name and "Rank" in name)


def player_form(
    df: DataFrame,
    entity: Sequence[str],
    matchup: Sequence[str],
    order: Sequence,
    measures: Sequence[str],
    played: Column,
    include_current: str = "never",
    windows: Sequence[int] = (3, 7),
    zero_fill: Callable[[str], bool] | None = keep_rank_nulls,
    extra: Sequence[Running | Framed] = (),
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Form per entity and per matchup: six outputs for each measure. Crowded
    groups are measured once per key set, on the input; ``extra`` outputs ride
    along with the entity's."""
    shared = dict(windows=windows, played=played, include_current=include_current, zero_fill=zero_fill)
    by_entity = hot_groups(df, entity, bounded_by)
    finer = set(entity) <= set(matchup)
    by_matchup = None if finer and by_entity is None else hot_groups(df, matchup, bounded_by)
    own = rolling_form(df, entity, order, measures, extra=extra, hot=by_entity, **shared)
    return rolling_form(own, matchup, order, measures, prefix="matchup_", hot=by_matchup, **shared)


def games_played(
    df: DataFrame, entity: Sequence[str], order: Sequence, game: str, alias: str, hot="measure", bounded_by=()
) -> DataFrame:
    """Running count of known game ids, the current row included."""
    return over_ordered(df, entity, order, [Running(alias, F.col(game), "count")], hot=hot, bounded_by=bounded_by)


def playoff_flag(games: str, season_games: int = 82, flag: str | None = None) -> Column:
    """1 beyond the regular season; a given flag column wins over the count."""
    counted = F.when(F.col(games) > season_games, 1).otherwise(0)
    return F.coalesce(F.col(flag).cast("int"), counted) if flag else counted


def previous_row(df, entity, order, measures, prefix="lag_", hot="measure", bounded_by=()):
    """Value of the row before, nulls kept."""
    outputs = [Framed(f"{prefix}{m}", (lambda w, m=m: F.lag(m).over(w)), back=1) for m in measures]
    return over_ordered(df, entity, order, outputs, hot=hot, bounded_by=bounded_by)


def running_totals(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence,
    measures: Sequence[str],
    games: str | None = None,
    digits: int = 2,
    hot="measure",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """``rolling_<m>``: running sum; with ``games`` also ``rolling_per_game_<m>``."""
    outputs = [Running(f"_r{i}", F.col(m), "sum") for i, m in enumerate(measures)]
    done = over_ordered(df, entity, order, outputs, hot=hot, bounded_by=bounded_by)
    summed = done.select(
        *df.columns, *[round_half_up(f"_r{i}", digits).alias(f"rolling_{m}") for i, m in enumerate(measures)]
    )
    if games is None:
        return summed
    return summed.select(
        "*", *[ratio(f"rolling_{m}", games, digits).alias(f"rolling_per_game_{m}") for m in measures]
    )


def group_median(df: DataFrame, keys: Sequence[str], measures: dict[str, str], hot="measure", bounded_by=()) -> DataFrame:
    """One row per group with the exact median of each measure (name -> alias).

    Groups above the hot limit are reduced to the counts of the values around
    the middle, which a sketch of guaranteed error brackets; the middle values
    are found from running counts over them.
    """
    if isinstance(hot, str):
        hot = hot_groups(df, keys, bounded_by)
    cold_rows, hot_rows = split_hot(df, keys, hot)
    plain = cold_rows.groupBy(*keys).agg(*[F.median(m).alias(a) for m, a in measures.items()])
    if hot_rows is None:
        return plain
    parts = hot_rows.select(*keys).distinct()
    edges = _median_edges(hot_rows, keys, measures)
    for i, (m, alias) in enumerate(measures.items()):
        near = edges.select(*keys, F.col(f"_edges{i}")[0].alias("_low"), F.col(f"_edges{i}")[1].alias("_high"))
        parts = null_safe_join(parts, _median_from_counts(hot_rows, keys, m, alias, near), keys, "left")
    return parts if not keys else plain.unionByName(parts)


def _median_edges(rows, keys, measures):
    """Per group, for each measure two values that the middle lies between: their
    ranks are a few ten-thousandths below and above it, the sketch's error told in."""
    away = 3 / MEDIAN_ACCURACY
    cuts = F.array(F.lit(0.5 - away), F.lit(0.5 + away))
    sketched = [F.percentile_approx(F.col(m).cast("double"), cuts, MEDIAN_ACCURACY).alias(f"_edges{i}") for i, m in enumerate(measures)]
    return broadcast_if_small(reliable_checkpoint(rows.groupBy(*keys).agg(*sketched))) if keys else rows.agg(*sketched)


def _median_from_counts(rows, keys, measure, alias, edges):
    """Values outside the edges are counted in one row a side; if a middle lies
    there after all, every value is counted."""
    value = F.col(measure).cast("double")
    known = null_safe_join(rows.select(*keys, measure).filter(F.col(measure).isNotNull()), edges, keys, "left")
    side = F.when(value < F.col("_low"), -1).when(value > F.col("_high"), 1).otherwise(0)
    sided = known.select(*keys, side.alias("_side"), F.when(side == 0, F.col(measure)).alias(measure))
    found = reliable_checkpoint(_middles(sided, keys, measure, alias))
    if not found.filter("_missed").isEmpty():
        found = _middles(known.select(*keys, F.lit(0).alias("_side"), measure), keys, measure, alias)
    return found.drop("_missed")


def _middles(rows, keys, measure, alias):
    counts = rows.groupBy(*keys, "_side", measure).agg(F.count(F.lit(1)).alias("_c"))
    placed = over_ordered(counts, keys, ["_side", measure], [Running("_upto", F.col("_c"), "sum")])
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_size"))
    placed = null_safe_join(placed, sizes, keys, "inner")
    first = F.floor((F.col("_size") + 1) / 2)
    second = F.floor((F.col("_size") + 2) / 2)

    def holds(place):
        return (F.col("_upto") >= place) & (F.col("_upto") - F.col("_c") < place)

    value = F.col(measure).cast("double")
    middle = placed.filter(holds(first) | holds(second)).groupBy(*keys)
    return middle.agg(
        ((F.max(F.when(holds(first), value)) + F.max(F.when(holds(second), value))) / 2).alias(alias),
        F.coalesce(F.bool_or(F.col("_side") != 0), F.lit(False)).alias("_missed"),
    )


def _median_beside(measure: str, keys: Sequence[str]) -> Framed:
    """Whole-group median next to the rows: shares the shuffle of the form
    windows, for groups of ordinary size."""
    return Framed(f"_median_{measure}", lambda _: F.median(measure).over(Window.partitionBy(*keys)))


def team_form(
    df: DataFrame,
    team: str,
    opponent: str,
    order: Sequence,
    measures: Sequence[str],
    games: str,
    matchup_games: str,
    include_current: str = "always",
    digits: int = 2,
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Form of the team, of what was done against the opponent faced, and of
    the matchup. While too few games are played (previous: 2, last-3: 4,
    last-7: 8) the median of the whole group stands in."""
    views = [("", [team], games), ("opponent_", [opponent], games), ("matchup_", [team, opponent], matchup_games)]
    out = df
    for prefix, keys, counter in views:
        hot = hot_groups(df, keys, bounded_by)
        extra = [] if hot is not None else [_median_beside(m, keys) for m in measures]
        formed = rolling_form(
            out, keys, order, measures, include_current=include_current, prefix=prefix, digits=digits, extra=extra, hot=hot
        )
        if hot is not None:
            medians = group_median(df, keys, {m: f"_median_{m}" for m in measures}, hot=hot)
            formed = null_safe_join(formed, medians, keys, "left")
        warm = {f"{prefix}previous_{m}": (1, m) for m in measures}
        warm |= {f"{prefix}average_{m}_last_{n}_games": (n, m) for m in measures for n in (3, 7)}
        out = formed.select(
            *out.columns,
            *[
                F.when(F.col(counter) > n, F.col(name)).otherwise(round_half_up(f"_median_{m}", digits)).alias(name)
                for name, (n, m) in warm.items()
            ],
        )
    return out


def own_opponent_form(
    df: DataFrame, team: str, opponent: str, game: str, order: Sequence, measures: Sequence[str], prefix="own_opponent_",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Form the opponent itself brought into the game: its own previous known
    value and means, taken from its row of the same game."""
    formed = rolling_form(df, [team], order, measures, bounded_by=bounded_by)
    names = [c for c in formed.columns if c not in df.columns]
    theirs = formed.select(
        F.col(game).alias("_game"), F.col(team).alias("_team"), *[F.col(n).alias(prefix + n) for n in names]
    )
    met = (df[game] == theirs["_game"]) & (df[opponent] == theirs["_team"])
    return df.join(theirs, met, "left").drop("_game", "_team")


def season_hit_rate(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    value: str,
    games: str,
    thresholds: Sequence[int] = (2, 3),
    pattern: str = "hit_rate_{}plus",
    min_games: int = 1,
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Hits so far / games so far, null until more than ``min_games`` games.
    Rows of the same date share the sum, so hits are summed per date first: a
    group holds one row per date however many facts it has."""
    flags = {t: at_least(value, t) for t in thresholds}
    daily = df.groupBy(*entity, date).agg(*[F.sum(f).alias(f"_h{t}") for t, f in flags.items()])
    running = [Running(f"_s{t}", F.col(f"_h{t}"), "sum") for t in thresholds]
    sums = over_ordered(daily, entity, [date], running, bounded_by=bounded_by).drop(*[f"_h{t}" for t in thresholds])
    return null_safe_join(df, sums, [*entity, date], "left").select(
        *df.columns,
        *[
            F.when(F.col(games) > min_games, ratio(f"_s{t}", games, 4)).alias(pattern.format(t))
            for t in thresholds
        ],
    )


def hit_rate_last_days(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    value: str,
    days: int = 30,
    thresholds: Sequence[int] = (2, 3),
    pattern: str = "last{1}_hit_rate_{0}plus",
) -> DataFrame:
    """Share of hits among the known values of the last ``days`` calendar days,
    the row's own day included; computed over per-day sums."""
    day = F.unix_date(F.to_date(F.col(date)))
    daily = df.groupBy(*entity, day.alias("_day")).agg(
        *[F.sum(at_least(value, t)).alias(f"_h{t}") for t in thresholds], F.count(value).alias("_n")
    )
    window = Window.partitionBy(*entity).orderBy("_day").rangeBetween(-days, 0)
    rates = daily.select(
        *entity,
        "_day",
        *[ratio(F.sum(f"_h{t}").over(window), F.sum("_n").over(window), 4).alias(f"_r{t}") for t in thresholds],
    )
    return null_safe_join(df.withColumn("_day", day), rates, [*entity, "_day"], "left").select(
        *df.columns, *[F.col(f"_r{t}").alias(pattern.format(t, days)) for t in thresholds]
    )
