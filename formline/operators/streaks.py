"""Streaks and hit rates over an entity's newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.operators.joins import null_safe_join


def current_streak(df: DataFrame, entity: Sequence[str], order: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """Per entity and condition: how many of the newest rows in a row meet it.

    The newest row that breaks a condition is an aggregate, and the streak is
    the count of rows after it, so no group is ever sorted in one place.
    ``order`` lists plain columns, oldest first; a null condition is a break.
    """
    met = {name: F.coalesce(c, F.lit(False)) for name, c in conditions.items()}
    rows = df.select(*entity, F.struct(*order).alias("_at"), *[c.alias(f"_m_{n}") for n, c in met.items()])
    breaks = rows.groupBy(*entity).agg(
        *[F.max(F.when(~F.col(f"_m_{n}"), F.col("_at"))).alias(f"_b_{n}") for n in met]
    )
    placed = null_safe_join(rows, breaks, entity, "left")
    after = {n: F.col(f"_b_{n}").isNull() | (F.col("_at") > F.col(f"_b_{n}")) for n in met}
    return placed.groupBy(*entity).agg(*[F.count_if(c).alias(n) for n, c in after.items()])


def win_loss_streak(df: DataFrame, entity: Sequence[str], order: Sequence[str], won: Column, alias: str = "streak") -> DataFrame:
    """``W3`` or ``L2``: outcome of the newest row and how long it has held."""
    counts = current_streak(df, entity, order, {"_w": won, "_l": ~won})
    label = F.when(F.col("_w") > 0, F.concat(F.lit("W"), "_w")).when(F.col("_l") > 0, F.concat(F.lit("L"), "_l"))
    return counts.select(*entity, label.alias(alias))


def newest_rows(df: DataFrame, entity: Sequence[str], newest_first: Sequence, rows: int, number: str = "_rn") -> DataFrame:
    """The newest rows of each entity. Spark limits every group before the
    shuffle, so at most ``rows`` per entity and map task travel."""
    window = Window.partitionBy(*entity).orderBy(*newest_first)
    return df.withColumn(number, F.row_number().over(window)).filter(F.col(number) <= rows)


def hit_rates_last_n(
    df: DataFrame,
    entity: Sequence[str],
    newest_first: Sequence,
    hits: dict[str, Column],
    totals: dict[str, Column] | None = None,
    sizes: Sequence[int] = (5, 10, 15, 20),
    streaks: dict[str, Column] | None = None,
) -> DataFrame:
    """Hits, totals and row counts over the newest 5, 10, 15 and 20 rows, all
    sizes from one pass: columns ``<name>_last_<n>`` and ``n_last_<n>``. Each of
    ``streaks`` counts how many of the newest rows in a row meet a condition,
    within the largest size."""
    recent = newest_rows(df, entity, newest_first, max(sizes))
    columns = []
    for n in sizes:
        inside = F.col("_rn") <= n
        columns += [F.count_if(inside & c).alias(f"{name}_last_{n}") for name, c in hits.items()]
        columns += [
            F.sum(F.when(inside, F.coalesce(c, F.lit(0)))).alias(f"{name}_last_{n}") for name, c in (totals or {}).items()
        ]
        columns.append(F.count_if(inside).alias(f"n_last_{n}"))
    for name, c in (streaks or {}).items():
        broken = F.min(F.when(~F.coalesce(c, F.lit(False)), F.col("_rn")))
        columns.append(F.coalesce(broken - 1, F.count(F.lit(1))).cast("long").alias(name))
    return recent.groupBy(*entity).agg(*columns)
