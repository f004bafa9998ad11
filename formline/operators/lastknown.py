"""Latest row per key and fills from the last known values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.operators.joins import null_safe_join


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` per key. ``max_by`` combines before
    the shuffle, so a key with very many rows costs one row per map task."""
    columns = [c for c in (columns or df.columns) if c not in keys]
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    columns = [c for c in (columns or df.columns) if c not in keys]
    best = F.min_by(F.struct(*columns), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def first_known_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None, newest: bool = False
) -> DataFrame:
    """One row per key with each column's first (or newest) known value in
    ``order``; the values may come from different rows."""
    columns = [c for c in (columns or df.columns) if c not in keys]
    pick = F.max_by if newest else F.min_by
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*[pick(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def last_known_fill(
    df: DataFrame, history: DataFrame, levels: Sequence[tuple[Sequence[str], Sequence[str]]], order: Sequence[str]
) -> DataFrame:
    """Fill nulls of ``df`` from the latest history row, level by level.

    Each level is (keys, columns): e.g. the matchup first, then the team, then
    the opponent. One join per level, one coalesce per column.
    """
    filled, sources = df, {}
    first_keys = list(levels[0][0])
    every = list(dict.fromkeys(c for _, columns in levels for c in [*columns, *order]))
    finest = latest_per_key(history, first_keys, order, [c for c in every if c not in first_keys])
    for i, (keys, columns) in enumerate(levels):
        # A level whose keys are part of the first level's is reduced from that
        # level's latest rows, and the history is aggregated once.
        latest = finest if i == 0 else latest_per_key(finest if set(keys) <= set(first_keys) else history, keys, order)
        latest = latest.select(*keys, *[F.col(c).alias(f"_k{i}_{c}") for c in columns])
        filled = null_safe_join(filled, latest, keys, "left")
        for c in columns:
            sources.setdefault(c, []).append(f"_k{i}_{c}")
    own = set(df.columns)
    extra = [c for c in sources if c not in own]
    return filled.select(
        *[F.coalesce(F.col(c), *sources[c]).alias(c) if c in sources else F.col(c) for c in df.columns],
        *[F.coalesce(*sources[c]).alias(c) for c in extra],
    )
