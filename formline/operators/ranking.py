"""Ranks within a league, usage ranks, latest flags and ordinal percentiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.functions.numbers import round_half_up
from formline.operators.joins import null_safe_join
from formline.operators.ordered import Framed, Running, hot_groups, over_ordered, split_hot


def against_is_lower_better(name: str) -> bool:
    return "Against" in name


def _direction(measure: str, lower: bool) -> Column:
    return F.col(measure).asc_nulls_last() if lower else F.col(measure).desc_nulls_last()


def rank_form(
    df: DataFrame,
    within: Sequence[str],
    measures: Sequence[str],
    lower_is_better: Callable[[str], bool] = against_is_lower_better,
    percent: bool = True,
    digits: int = 2,
    hot="measure",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """``rank_<m>`` (1 is best) and ``perc_rank_<m>`` = 1 − percent rank.

    A hot group is ranked from value counts: rows with the same value share one
    rank, so counting rows per value and summing the counts over the sorted
    values gives the ranks without sorting the rows themselves.
    """
    if isinstance(hot, str):
        hot = hot_groups(df, within, bounded_by)
    cold, crowded = split_hot(df, within, hot)
    columns = []
    for m in measures:
        window = Window.partitionBy(*within).orderBy(_direction(m, lower_is_better(m)))
        columns.append(F.rank().over(window).cast("long").alias(f"rank_{m}"))
        if percent:
            columns.append(round_half_up(1 - F.percent_rank().over(window), digits).alias(f"perc_rank_{m}"))
    plain = cold.select("*", *columns)
    if crowded is None:
        return plain
    ranked = crowded
    for m in measures:
        ranked = null_safe_join(
            ranked, _ranks_of_values(crowded, within, m, lower_is_better(m), percent, digits), [*within, m], "left"
        )
    ranked = ranked.select(*plain.columns)
    return ranked if not within else plain.unionByName(ranked)


def _ranks_of_values(rows, within, measure, lower, percent, digits):
    counts = rows.groupBy(*within, measure).agg(F.count(F.lit(1)).alias("_c"))
    ahead = Running("_ahead", F.col("_c"), "sum", strict=True)
    placed = over_ordered(counts, within, [_direction(measure, lower)], [ahead])
    placed = null_safe_join(placed, counts.groupBy(*within).agg(F.sum("_c").alias("_size")), within, "inner")
    rank = F.coalesce(F.col("_ahead"), F.lit(0)) + 1
    share = F.coalesce(F.try_divide((rank - 1).cast("double"), F.col("_size") - 1), F.lit(0.0))
    chosen = [*within, measure, rank.cast("long").alias(f"rank_{measure}")]
    if percent:
        chosen.append(round_half_up(1 - share, digits).alias(f"perc_rank_{measure}"))
    return placed.select(*chosen)


def usage_rank(df: DataFrame, within: Sequence[str], measure: str, alias: str, bounded_by=()) -> DataFrame:
    """Rank by a usage measure inside one team and game, nulls last."""
    ranked = rank_form(
        df, within, [measure], lower_is_better=lambda _: False, percent=False, bounded_by=bounded_by
    )
    return ranked.withColumnRenamed(f"rank_{measure}", alias)


def is_latest(alias: str) -> Framed:
    """Output that is 1 on the last row in the order, else 0."""
    return Framed(alias, lambda w: F.lead(F.lit(1)).over(w).isNull().cast("int"), ahead=1)


def latest_flag(df: DataFrame, entity: Sequence[str], order: Sequence, alias: str, bounded_by=()) -> DataFrame:
    """1 on the last row of each entity in ``order``, else 0."""
    return over_ordered(df, entity, order, [is_latest(alias)], bounded_by=bounded_by)


def latest_date_flag(df: DataFrame, entity: Sequence[str], date: str, alias: str) -> DataFrame:
    """1 on every row of the entity's latest date, else 0."""
    latest = df.groupBy(*entity).agg(F.max(date).alias("_latest"))
    joined = null_safe_join(df, latest, entity, "left")
    return joined.select(*df.columns, (F.col(date) == F.col("_latest")).cast("int").alias(alias))


def newest_first_counter(
    df: DataFrame, entity: Sequence[str], newest_first: Sequence, alias: str, flag: str | None = None, flag_from: int = 2,
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Row number with the newest row first; ``flag`` marks numbers from
    ``flag_from`` on."""
    counted = over_ordered(df, entity, newest_first, [Running(alias, F.lit(1), "count")], bounded_by=bounded_by)
    return counted.withColumn(flag, F.col(alias) >= flag_from) if flag else counted


def ordinal_percentile(df: DataFrame, order: Sequence, alias: str, digits: int = 4, within: Sequence[str] = (), bounded_by: Sequence[DataFrame] | int = ()) -> DataFrame:
    """(n − 1 − i) / (n − 1) for the i-th row, 0.5 when the group has one row.
    ``order`` must be unique; the whole league may be the group."""
    within = list(within)
    numbered = over_ordered(df, within, order, [Running("_place", F.lit(1), "count")], bounded_by=bounded_by)
    sizes = df.groupBy(*within).agg(F.count(F.lit(1)).alias("_size"))
    joined = null_safe_join(numbered, sizes, within, "inner")
    value = F.when(F.col("_size") <= 1, F.lit(0.5)).otherwise(
        round_half_up(F.try_divide((F.col("_size") - F.col("_place")).cast("double"), F.col("_size") - 1), digits)
    )
    return joined.select(*df.columns, value.alias(alias))
