"""Expressions on play events: clock, strength situation, shot danger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formline.functions.numbers import as_column

# Fixed values of the play data.
GOAL_X, GOAL_Y = 89.0, 0.0
HIGH_DANGER_FEET, HIGH_DANGER_DEGREES = 15.0, 35.0
MEDIUM_DANGER_FEET, MEDIUM_DANGER_DEGREES = 35.0, 50.0
PERIOD_SECONDS, OVERTIME_SECONDS, REGULAR_PERIODS = 1200, 300, 3
EVEN_STRENGTH_CODE = "1551"
EVEN, POWER_PLAY, PENALTY_KILL = "5on5", "5on4", "4on5"
SHOT_EVENTS = ("shot-on-goal", "goal")
ATTEMPT_EVENTS = ("shot-on-goal", "missed-shot", "blocked-shot", "goal")


def clock_seconds(c: Column | str) -> Column:
    """``MM:SS`` to seconds; 0 for anything that is not a clock reading."""
    parts = F.split(as_column(c), ":")
    seconds = F.try_element_at(parts, F.lit(1)).try_cast("int") * 60 + F.try_element_at(parts, F.lit(2)).try_cast("int")
    return F.coalesce(seconds, F.lit(0))


def game_seconds(period: Column | str, clock: Column | str) -> Column:
    """Seconds since the start of the game, the clock showing time remaining."""
    period = as_column(period)
    length = F.when(period <= REGULAR_PERIODS, PERIOD_SECONDS).otherwise(OVERTIME_SECONDS)
    finished = F.least(period - 1, F.lit(REGULAR_PERIODS)) * PERIOD_SECONDS
    return F.when(period > 0, finished + length - clock_seconds(clock)).otherwise(0)


def situation(code: Column | str, is_home: Column) -> Column:
    """Strength class seen from one side. The second digit of the code counts
    the away skaters, the third the home skaters; unreadable means even."""
    code = as_column(code)
    away = F.substring(code, 2, 1).try_cast("int")
    home = F.substring(code, 3, 1).try_cast("int")
    lead = F.when(is_home, home - away).otherwise(away - home)
    usable = F.length(code) >= 4
    return F.when(usable & (lead > 0), POWER_PLAY).when(usable & (lead < 0), PENALTY_KILL).otherwise(EVEN)


def strength_flag(code: Column | str, is_home: Column) -> Column:
    """PP / PK / EV label of a shot."""
    kind = situation(code, is_home)
    return F.when(kind == POWER_PLAY, "PP").when(kind == PENALTY_KILL, "PK").otherwise("EV")


def shot_danger(x: Column | str, y: Column | str) -> Column:
    """``low``, ``medium`` or ``high`` by distance and angle to the goal;
    missing coordinates count as medium."""
    x, y = as_column(x).cast("double"), as_column(y).cast("double")
    distance = F.sqrt((x - GOAL_X) * (x - GOAL_X) + (y - GOAL_Y) * (y - GOAL_Y))
    angle = F.when(x == GOAL_X, 0.0).otherwise(F.abs(F.degrees(F.atan2(y - GOAL_Y, F.lit(GOAL_X) - x))))
    return (
        F.when(x.isNull() | y.isNull(), "medium")
        .when((distance <= HIGH_DANGER_FEET) & (angle <= HIGH_DANGER_DEGREES), "high")
        .when((distance <= MEDIUM_DANGER_FEET) & (angle <= MEDIUM_DANGER_DEGREES), "medium")
        .otherwise("low")
    )
