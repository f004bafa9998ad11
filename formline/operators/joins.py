"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join where null matches null; the left keys are kept.

    Serves ``inner``, ``left``, ``left_semi`` and ``left_anti``. ``<=>`` is
    planned as an ordinary equi key, so no sentinel value is needed. Without
    keys, ``right`` must be a one-row aggregate; its values are attached as
    scalar subqueries.
    """
    if not on:
        if how not in ("inner", "left"):
            raise ValueError("a join without keys attaches scalars only")
        return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    names = {key: f"_rk{i}" for i, key in enumerate(on)}
    marked = right.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    joined = left.join(marked, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a count shows at most ``rows`` rows; otherwise
    the frame is returned as it is and the join is shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_apart_from_nulls(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """``left`` or ``full_outer`` equi join in which rows with a null key, which
    can match nothing, go round the join: a shuffle would send them all to one
    task."""
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    joined = left.filter(has_key).join(right.filter(has_key), list(on), how)
    out = joined.unionByName(left.filter(~has_key), allowMissingColumns=True)
    if how == "full_outer":
        out = out.unionByName(right.filter(~has_key), allowMissingColumns=True)
    return out


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join for a right side with many rows per key.

    Adaptive execution cannot split a crowded key on the right of an outer
    join. The matches are therefore an inner join, where it can split either
    side, and the rows without match an anti join against the distinct keys.
    """
    unmatched = left.join(right.select(*on).distinct(), list(on), "left_anti")
    return left.join(right, list(on), "inner").unionByName(unmatched, allowMissingColumns=True)
