"""Rounding, safe ratios and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """Round through DECIMAL(38,6), so that ties fall the same way in every
    SQL engine, whatever the size of the value (below 1e32)."""
    return F.round(as_column(c).cast("decimal(38,6)"), digits).cast("double")


def ratio(part: Column | str, whole: Column | str, digits: int | None = 2) -> Column:
    """part / whole as double, null when the whole is zero or null."""
    value = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))
    return value if digits is None else round_half_up(value, digits)


def at_least(c: Column | str, threshold: float) -> Column:
    """1/0 flag that stays null for a null value."""
    c = as_column(c)
    return F.when(c >= threshold, 1).when(c.isNotNull(), 0)


def gap(a: Column | str, b: Column | str, absolute: bool = True, digits: int = 2) -> Column:
    value = round_half_up(as_column(a) - as_column(b), digits)
    return F.abs(value) if absolute else value


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def zero_if_null_when(played: Column, c: Column | str) -> Column:
    """Zero-fill only rows that were played; other rows keep their nulls."""
    return F.when(played, zero_if_null(c)).otherwise(as_column(c))


def is_count_name(name: str, skip: Sequence[str] = ("Rank", "Percentage", "Per")) -> bool:
    """Counts may be zero-filled; ranks and percentages may not."""
    return not any(part in name for part in skip)


def percent_share(part: Column, whole_for: Column, whole_against: Column, empty: float = 50.0) -> Column:
    """100 * part / (for + against), ``empty`` when both are zero."""
    total = whole_for + whole_against
    return F.when(total > 0, round_half_up(F.try_divide(part.cast("double"), total) * 100)).otherwise(F.lit(empty))
