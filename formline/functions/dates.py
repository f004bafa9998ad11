"""Dates that arrive in several spellings, seasons and day labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions.numbers import as_column

# The spellings dates are accepted in.
GAME_DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd")
SCHEDULE_DATE_FORMATS = ("M/d/yy", "M/d/yyyy", "yyyy-MM-dd")


def parse_date(c: Column | str, formats: Sequence[str] = GAME_DATE_FORMATS) -> Column:
    """First format that fits; null when none does. Numbers such as 20240105
    and dates are accepted as well."""
    text = F.trim(as_column(c).cast("string"))
    parsed = []
    for fmt in formats:
        if fmt.endswith("/yy"):
            # A two-digit year must not swallow a four-digit one.
            short = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), text)
            parsed.append(F.try_to_date(short, fmt))
        else:
            parsed.append(F.try_to_date(text, fmt))
    return F.coalesce(*parsed)


def date_as_int(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyyMMdd").cast("int")


def day_label(c: Column | str) -> Column:
    """Short day name with a dot, as in schedules: ``Fri.``"""
    return F.concat(F.date_format(as_column(c), "E"), F.lit("."))


def day_number(c: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(as_column(c)) + 1


def season_code(date: Column | str, first_month: int = 7) -> Column:
    """Eight-digit season, e.g. 20232024, for seasons that start mid-year."""
    date = as_column(date)
    start = F.year(date) - F.when(F.month(date) < first_month, 1).otherwise(0)
    return (start * 10000 + start + 1).cast("int")


def season_by_boundaries(date: Column | str, starts: dict[str, int], default: int | None = None) -> Column:
    """Season whose start date (ISO text -> season) is the latest not after ``date``."""
    date = as_column(date)
    chain = None
    for start in sorted(starts, reverse=True):
        hit = date >= F.lit(start).cast("date")
        chain = F.when(hit, starts[start]) if chain is None else chain.when(hit, starts[start])
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def within_days(date: Column | str, days: int, as_of: Column | None = None) -> Column:
    today = F.current_date() if as_of is None else as_of
    return F.datediff(today, as_column(date)) <= days


def local_date(instant: Column | str, zone: str = "America/New_York") -> Column:
    """Calendar date of a UTC instant in a zone."""
    return F.to_date(F.from_utc_timestamp(as_column(instant), zone))


def as_day(value: str | date, plus: int = 0) -> date:
    """A date from a date or ISO text, moved by ``plus`` days."""
    day = date.fromisoformat(value[:10]) if isinstance(value, str) else value
    return day + timedelta(days=plus)


def day_range(df: DataFrame, column: str, first=None, last=None) -> Column:
    """The row's day lies in [first, last]; either end may be open.

    Written on the bare column when it is a date or a timestamp, so that the
    condition reaches the scan and prunes files and partitions; a cast around
    the column would keep it from there.
    """
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        def low(v):
            return c >= F.lit(as_day(v).isoformat()).cast(kind)

        def high(v):
            return c < F.lit(as_day(v, 1).isoformat()).cast(kind)
    else:
        day = c if isinstance(kind, T.DateType) else F.to_date(c)

        def low(v):
            return day >= F.lit(as_day(v))

        def high(v):
            return day <= F.lit(as_day(v))
    parts = ([low(first)] if first is not None else []) + ([high(last)] if last is not None else [])
    return F.lit(True) if not parts else parts[0] if len(parts) == 1 else parts[0] & parts[1]
