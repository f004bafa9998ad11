"""Play events to game statistics: team and player counts by situation,
possession, rebounds, zone continuation, ice time."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.functions.numbers import percent_share
from formline.functions.play import (
    ATTEMPT_EVENTS,
    EVEN,
    EVEN_STRENGTH_CODE,
    PENALTY_KILL,
    POWER_PLAY,
    SHOT_EVENTS,
    clock_seconds,
    shot_danger,
    situation,
)
from formline.operators.joins import broadcast_if_small, null_safe_join
from formline.operators.matching import first_within_tolerance, merge_intervals, totals_inside
from formline.operators.ordered import Framed, over_ordered
from formline.operators.shape import all_plus_each, sums_plus_each
from formline.session import reliable_checkpoint

SITUATIONS = ("all", POWER_PLAY, PENALTY_KILL, EVEN)
#: Players of games whose rows are summed and joined in one task.
TASK_PLAYERS = 20_000
DANGERS = ("low", "medium", "high")

# Counter name -> event types that add to it.
COUNTERS = {
    "shotsOnGoal": SHOT_EVENTS,
    "goals": ("goal",),
    "missedShots": ("missed-shot",),
    "blockedShotAttempts": ("blocked-shot",),
    "hits": ("hit",),
    "takeaways": ("takeaway",),
    "giveaways": ("giveaway",),
    "faceOffsWon": ("faceoff",),
    "penalties": ("penalty",),
}


def by_side(events: DataFrame) -> DataFrame:
    """Two rows per event, one per team of the game: ``team_id``, ``is_home``,
    ``is_own`` (the team owns the event) and ``situation`` from its side."""
    sides = F.array(
        F.struct(F.col("home_id").alias("id"), F.lit(True).alias("h")),
        F.struct(F.col("away_id").alias("id"), F.lit(False).alias("h")),
    )
    doubled = events.withColumn("_side", F.explode(sides))
    return doubled.select(
        *events.columns,
        F.col("_side.id").alias("team_id"),
        F.col("_side.h").alias("is_home"),
        F.coalesce(F.col("owner_id") == F.col("_side.id"), F.lit(False)).alias("is_own"),
        situation(F.coalesce("code", F.lit(EVEN_STRENGTH_CODE)), F.col("_side.h")).alias("situation"),
    )


def counter_columns(own: Column, suffixes=("For", "Against"), event_type: str = "type", weight=None) -> list[Column]:
    """Conditional sums of every counter and danger class for both sides."""
    weight = F.lit(1) if weight is None else weight

    def total(condition, name):
        return F.sum(F.when(condition, weight).otherwise(0)).alias(name)

    columns = []
    for side, suffix in ((own, suffixes[0]), (~own, suffixes[1])):
        for name, types in COUNTERS.items():
            columns.append(total(side & F.col(event_type).isin(*types), name + suffix))
        for d in DANGERS:
            at = side & (F.col("danger") == d)
            columns.append(total(at & F.col(event_type).isin(*SHOT_EVENTS), f"{d}DangerShots{suffix}"))
            columns.append(total(at & (F.col(event_type) == "goal"), f"{d}DangerGoals{suffix}"))
    return columns


def with_derived_attempts(df: DataFrame, suffixes: Sequence[str] = ("For", "Against"), prefix: str = "") -> DataFrame:
    """Attempts, unblocked attempts and saved shots from the base counters."""
    columns = []
    for s in suffixes:
        shots, missed = F.col(f"{prefix}shotsOnGoal{s}"), F.col(f"{prefix}missedShots{s}")
        blocked, goals = F.col(f"{prefix}blockedShotAttempts{s}"), F.col(f"{prefix}goals{s}")
        columns += [
            (shots + missed + blocked).alias(f"{prefix}shotAttempts{s}"),
            (shots + missed).alias(f"{prefix}unblockedShotAttempts{s}"),
            (shots - goals).alias(f"{prefix}savedShotsOnGoal{s}"),
            (shots + missed - goals).alias(f"{prefix}savedUnblockedShotAttempts{s}"),
        ]
    return df.select("*", *columns)


def team_counts(events: DataFrame, game: Sequence[str] = ("game_id",)) -> DataFrame:
    """For/Against counters per (game, team, situation) and over all
    situations. Events are counted per kind before they are doubled, so only
    the counts of a game are expanded to its two teams."""
    kinds = ["home_id", "away_id", "owner_id", "code", "type", "danger"]
    counted = (
        events.withColumn("danger", shot_danger("x", "y")).groupBy(*game, *kinds).agg(F.count(F.lit(1)).alias("_n"))
    )
    sided = by_side(counted)
    columns = counter_columns(F.col("is_own"), weight=F.col("_n"))
    return with_derived_attempts(all_plus_each(sided, [*game, "team_id", "is_home"], "situation", columns))


def possession(events: DataFrame, game: Sequence[str] = ("game_id",)) -> DataFrame:
    """Corsi and Fenwick percentage per (game, team, situation): all attempts
    and the unblocked ones; 50 when there are none."""
    attempts = events.filter(F.col("type").isin(*ATTEMPT_EVENTS) & F.col("owner_id").isNotNull())
    kinds = ["home_id", "away_id", "owner_id", "code", "type"]
    sided = by_side(attempts.groupBy(*game, *kinds).agg(F.count(F.lit(1)).alias("_n")))
    own, unblocked = F.col("is_own"), F.col("type") != "blocked-shot"

    totals = {"_cf": own, "_ca": ~own, "_ff": own & unblocked, "_fa": ~own & unblocked}
    counted = sided.select(*game, "team_id", "situation", *[F.when(c, F.col("_n")).otherwise(0).alias(n) for n, c in totals.items()])
    summed = sums_plus_each(counted, [*game, "team_id"], "situation", list(totals))
    return summed.select(
        *game,
        "team_id",
        "situation",
        percent_share(F.col("_cf"), F.col("_cf"), F.col("_ca")).alias("corsiPercentage"),
        percent_share(F.col("_ff"), F.col("_ff"), F.col("_fa")).alias("fenwickPercentage"),
    )


def _sequences(events: DataFrame) -> DataFrame:
    """Events once per side for "all" and once for the side's own situation:
    neighbours are neighbours within that list."""
    sided = by_side(events)
    lists = F.array(F.lit("all"), F.col("situation"))
    return sided.withColumn("situation", F.explode(lists))


def rebound_output(team: str, kind: str, period: str, seconds: str, alias: str = "is_rebound", within: int = 3, shots=SHOT_EVENTS) -> Framed:
    """1 when the row is a shot or goal and so is the row right before it, by
    the same team in the same period at most ``within`` seconds away."""
    def build(w):
        def before(c):
            return F.lag(c).over(w)

        hit = (
            F.col(kind).isin(*shots)
            & before(kind).isin(*shots)
            & (F.col(team) == before(team))
            & (F.col(period) == before(period))
            & (F.abs(F.col(seconds) - before(seconds)) <= within)
        )
        return F.coalesce(hit, F.lit(False)).cast("int")

    return Framed(alias, build, back=1)


def zone_outputs(team: str, zone: str, inside: str = "continues_in", outside: str = "continues_out") -> list[Framed]:
    """1 when the next row belongs to the same team and lies in the same zone
    (``inside``) or in another zone (``outside``)."""
    def build(same_zone: bool):
        def of(w):
            following, owner = F.lead(zone).over(w), F.lead(team).over(w)
            place = following == F.col(zone) if same_zone else following != F.col(zone)
            return F.coalesce((owner == F.col(team)) & place, F.lit(False)).cast("int")

        return of

    return [Framed(inside, build(True), ahead=1), Framed(outside, build(False), ahead=1)]


def rebounds_and_zones(
    events: DataFrame, game: Sequence[str] = ("game_id",), bounded_by: Sequence[DataFrame] | int = ()
) -> DataFrame:
    """Rebounds, rebound goals and zone continuations For/Against per (game,
    team, situation); Against counts are the other team's in the same list."""
    keys = [*game, "team_id", "situation"]
    listed = _sequences(events).withColumn("seconds", clock_seconds("clock"))
    outputs = [rebound_output("owner_id", "type", "period", "seconds"), *zone_outputs("owner_id", "zone")]
    flagged = over_ordered(listed, keys, ["event_index"], outputs, bounded_by=bounded_by)
    own = F.col("is_own")
    other = F.col("owner_id").isNotNull() & ~own

    def total(side, flag, name):
        return F.sum(F.when(side, F.col(flag)).otherwise(0)).alias(name)

    flagged = flagged.withColumn(
        "is_rebound_goal", F.when(F.col("type") == "goal", F.col("is_rebound")).otherwise(0)
    )
    columns = []
    for side, suffix in ((own, "For"), (other, "Against")):
        columns += [
            total(side, "is_rebound", f"rebounds{suffix}"),
            total(side, "is_rebound_goal", f"reboundGoals{suffix}"),
            total(side, "continues_in", f"playContinuedInZone{suffix}"),
            total(side, "continues_out", f"playContinuedOutsideZone{suffix}"),
        ]
    return flagged.groupBy(*keys).agg(*columns)


def games_of(events: DataFrame, game: Sequence[str]) -> DataFrame:
    return events.select(*game, "home_id", "away_id").distinct()


def team_stats(
    events: DataFrame,
    games: DataFrame | None = None,
    game: Sequence[str] = ("game_id",),
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """All team statistics: one row per (game, team, situation), four
    situations for each team of each game, zero where nothing happened."""
    games = games_of(events, game) if games is None else games
    sides = F.array(
        F.struct(F.col("home_id").alias("i"), F.lit(True).alias("h")),
        F.struct(F.col("away_id").alias("i"), F.lit(False).alias("h")),
    )
    base = games.select(*game, F.explode(sides).alias("_s")).select(
        *game,
        F.col("_s.i").alias("team_id"),
        F.col("_s.h").alias("is_home"),
        F.explode(F.array(*[F.lit(s) for s in SITUATIONS])).alias("situation"),
    )
    keys = [*game, "team_id", "situation"]
    out = null_safe_join(base, team_counts(events, game).drop("is_home"), keys, "left")
    out = null_safe_join(out, possession(events, game), keys, "left")
    out = null_safe_join(out, rebounds_and_zones(events, game, bounded_by), keys, "left")
    empty = {c: 50.0 if c.endswith("Percentage") else 0 for c in out.columns if c not in (*keys, "is_home")}
    return out.fillna(empty)


# Which actor of which event types adds to which counter.
INDIVIDUAL = {
    "goals": ("scorer_id", ("goal",)),
    "shotsOnGoal": ("shooter_id", SHOT_EVENTS),
    "missedShots": ("shooter_id", ("missed-shot",)),
    "blockedShotAttempts": ("shooter_id", ("blocked-shot",)),
    "primaryAssists": ("assist1_id", None),
    "secondaryAssists": ("assist2_id", None),
    "hits": ("hitter_id", ("hit",)),
    "takeaways": ("actor_id", ("takeaway",)),
    "giveaways": ("actor_id", ("giveaway",)),
}
ACTORS = ("scorer_id", "shooter_id", "assist1_id", "assist2_id", "hitter_id", "actor_id")


def individual_counts(events: DataFrame, game: Sequence[str] = ("game_id",)) -> DataFrame:
    """``I_F_*`` counters per (game, player, skater code). A goal's scorer also
    counts as its shooter when no shooter is named."""
    shooter = F.coalesce("shooter_id", F.when(F.col("type") == "goal", F.col("scorer_id")))
    named = events.withColumn("shooter_id", shooter).withColumn("danger", shot_danger("x", "y"))
    roles = F.array(*[F.struct(F.lit(a).alias("role"), F.col(a).alias("id")) for a in ACTORS])
    acts = (
        named.select(*game, "code", "type", "danger", F.explode(roles).alias("_a"))
        .filter(F.col("_a.id").isNotNull())
        .select(*game, "code", "type", "danger", F.col("_a.role").alias("role"), F.col("_a.id").alias("player_id"))
    )

    def total(role, types, name, danger=None):
        condition = F.col("role") == role
        if types:
            condition = condition & F.col("type").isin(*types)
        if danger:
            condition = condition & (F.col("danger") == danger)
        return F.count_if(condition).alias(name)

    columns = [total(role, types, f"I_F_{name}") for name, (role, types) in INDIVIDUAL.items()]
    for d in DANGERS:
        columns.append(total("shooter_id", SHOT_EVENTS, f"I_F_{d}DangerShots", d))
        columns.append(total("scorer_id", ("goal",), f"I_F_{d}DangerGoals", d))
    return acts.groupBy(*game, "player_id", "code").agg(*columns)


# Attempts that are counted on the ice, by event type.
ICE_KINDS = {"saved": "shot-on-goal", "goals": "goal", "missed": "missed-shot", "blocked": "blocked-shot"}
OWNERS = ("own", "other", "unowned")


def _attempts(events: DataFrame, game) -> DataFrame:
    """Attempts with their class as seen by nobody's side: ``_owner`` (home,
    away, third, unowned) and ``_view`` (the situation of the home team)."""
    home_view = situation(F.coalesce("code", F.lit(EVEN_STRENGTH_CODE)), F.lit(True))
    owner = (
        F.when(F.col("owner_id") == F.col("home_id"), "home")
        .when(F.col("owner_id") == F.col("away_id"), "away")
        .when(F.col("owner_id").isNotNull(), "third")
        .otherwise("unowned")
    )
    return events.filter(F.col("type").isin(*ATTEMPT_EVENTS)).select(
        *game,
        "period",
        clock_seconds("clock").alias("at"),
        owner.alias("_owner"),
        home_view.alias("_view"),
        *[(F.col("type") == kind).cast("long").alias(name) for name, kind in ICE_KINDS.items()],
    )


def _seen_by_player(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Class sums of a player as ``<prefix>_<own|other|unowned>_<kind>`` in the
    situation of the player's side, a row a class, to be summed."""
    at_home = F.col("is_home")
    mine = F.when(at_home, "home").otherwise("away")
    whose = (
        F.when(F.col("_owner") == "unowned", "unowned").when(F.col("_owner") == mine, "own").otherwise("other")
    )
    mirrored = (
        F.when(F.col("_view") == POWER_PLAY, PENALTY_KILL).when(F.col("_view") == PENALTY_KILL, POWER_PLAY).otherwise(EVEN)
    )
    told = df.select(
        *keys, *ICE_KINDS, whose.alias("_whose"), F.when(at_home, F.col("_view")).otherwise(mirrored).alias("situation")
    )
    values = [F.when(F.col("_whose") == o, F.col(k)).otherwise(0).alias(f"{prefix}_{o}_{k}") for o in OWNERS for k in ICE_KINDS]
    return told.select(*keys, "situation", *values)


def ice_time(events: DataFrame, shifts: DataFrame, players: DataFrame, game: Sequence[str] = ("game_id",)) -> DataFrame:
    """Seconds on ice and shifts per (game, player, situation)."""
    return sums_plus_each(_timed_shifts(events, shifts, players, game), [*game, "player_id"], "situation", ["icetime", "shifts"])


def _timed_shifts(events: DataFrame, shifts: DataFrame, players: DataFrame, game: Sequence[str]) -> DataFrame:
    """A row a shift, to be summed: it counts for the situation of the first
    event within 5 seconds of its start."""
    timed = events.select(*game, "period", "event_index", "code", clock_seconds("clock").alias("at"))
    starts = shifts.select(
        *game, "player_id", "period", clock_seconds("startTime").alias("at"), clock_seconds("duration").alias("_s")
    )
    placed = first_within_tolerance(
        starts, timed, [*game, "period"], "at", "event_index", "code", 5, "code", EVEN_STRENGTH_CODE
    )
    sided = placed.join(players.select(*game, "player_id", "is_home"), [*game, "player_id"], "inner")
    return sided.select(
        *game, "player_id", situation(F.col("code"), F.col("is_home")).alias("situation"), F.col("_s").cast("double").alias("icetime"), F.lit(1).cast("long").alias("shifts")
    )


def _game_totals(attempts: DataFrame, game: Sequence[str]) -> DataFrame:
    """All attempts of a game per situation, as a player at home (``_home_...``)
    and one of the other side (``_away_...``) sees them: a few rows a game, told
    to the players after their own rows are summed."""
    classes = attempts.groupBy(*game, "_owner", "_view").agg(*[F.sum(k).alias(k) for k in ICE_KINDS])
    classes = reliable_checkpoint(classes)
    home = _seen_by_player(classes.withColumn("is_home", F.lit(True)), game, "_home")
    away = _seen_by_player(classes.withColumn("is_home", F.lit(False)), game, "_away")
    both = home.unionByName(away, allowMissingColumns=True)
    return sums_plus_each(both, game, "situation", [c for c in both.columns if c.startswith(("_home_", "_away_"))])


def player_stats(
    events: DataFrame,
    shifts: DataFrame,
    players: DataFrame,
    game: Sequence[str] = ("game_id",),
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """All player statistics: one row per (game, player, situation).

    ``players`` lists (game, player_id, is_home) with any further columns.
    Games without shifts have ``has_shifts`` false and null on/off-ice values.
    """
    sided = individual_counts(events, game).join(
        players.select(*game, "player_id", "is_home"), [*game, "player_id"], "inner"
    )
    own_counts = [c for c in sided.columns if c.startswith("I_F_")]
    individual = sided.select(
        *game, "player_id", situation(F.coalesce("code", F.lit(EVEN_STRENGTH_CODE)), F.col("is_home")).alias("situation"), *own_counts
    )

    # So many partitions that a task holds rows of a bounded number of players, however well the zeros compress.
    count = max(1, math.ceil(players.count() / TASK_PLAYERS))
    attempts = _attempts(events, game)
    classes = ["_owner", "_view"]
    spans = shifts.select(
        *game, "player_id", "period", clock_seconds("startTime").alias("_from"), clock_seconds("endTime").alias("_to")
    )
    spans = merge_intervals(spans, [*game, "player_id", "period"], "_from", "_to", bounded_by)
    # A span is looked at once per class of attempts its period has seen.
    spans = spans.join(attempts.select(*game, "period", *classes).distinct(), [*game, "period"], "inner")
    on_ice = totals_inside(
        attempts, spans, [*game, "period", *classes], ["player_id"], "at", "_from", "_to", list(ICE_KINDS), bounded_by, merged=True, parts=count
    )
    members = players.select(*game, "player_id", "is_home")
    on_ice = _seen_by_player(on_ice.join(members, [*game, "player_id"], "inner"), [*game, "player_id"], "on")

    shifted = shifts.select(*game).distinct().withColumn("has_shifts", F.lit(True))
    base = players.join(shifted, list(game), "left").fillna({"has_shifts": False})
    # How often a player is listed for each side: the game's totals count as often.
    listed = Window.partitionBy(*game, "player_id")
    at_home = F.coalesce("is_home", F.lit(False))
    base = base.withColumns({f"_{side}s": F.count_if(c).over(listed) for side, c in (("home", at_home), ("away", ~at_home))})
    keys = [*game, "player_id", "situation"]
    cells = base.withColumn("situation", F.explode(F.array(*[F.lit(s) for s in SITUATIONS])))
    # The three parts have the same keys: stacked, they are summed in one aggregation.
    stacked = individual
    for part in (_timed_shifts(events, shifts, players, game), on_ice):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in keys]
    sums = sums_plus_each(stacked.repartition(count, *game, "player_id"), [*game, "player_id"], "situation", measures)

    def placed(df):
        return df.withColumn("_key", F.struct(*keys)).repartition(count, "_key")  # equal structs have equal or missing parts

    out = placed(cells).join(placed(sums).drop(*keys), "_key", "left").drop("_key")
    out = out.join(broadcast_if_small(_game_totals(attempts, game)), [*game, "situation"], "left")
    wholes = {c.replace("_home_", "all_", 1): c for c in out.columns if c.startswith("_home_")}
    out = out.withColumns(
        {
            name: F.col("_homes") * F.coalesce(home, F.lit(0)) + F.col("_aways") * F.coalesce(home.replace("_home_", "_away_", 1), F.lit(0))
            for name, home in wholes.items()
        }
    )
    out = out.fillna(0, subset=measures)
    return out.select(*players.columns, "has_shifts", "situation", *_player_columns(own_counts))


def _player_columns(own_counts: Sequence[str]) -> list[Column]:
    i = {c.removeprefix("I_F_"): F.col(c) for c in own_counts}
    shots, missed, blocked, goals = i["shotsOnGoal"], i["missedShots"], i["blockedShotAttempts"], i["goals"]
    columns = [F.col(c) for c in own_counts]
    columns += [
        (goals + i["primaryAssists"] + i["secondaryAssists"]).alias("I_F_points"),
        (shots + missed + blocked).alias("I_F_shotAttempts"),
        (shots + missed).alias("I_F_unblockedShotAttempts"),
        (shots - goals).alias("I_F_savedShotsOnGoal"),
        (shots + missed - goals).alias("I_F_savedUnblockedShotAttempts"),
        F.col("icetime"),
        F.col("shifts"),
    ]

    def on(owner, kind):
        return F.col(f"on_{owner}_{kind}")

    def off(owner, kind):
        return F.col(f"all_{owner}_{kind}") - on(owner, kind)

    def against(where, kind):
        return where("other", kind) + where("unowned", kind)

    def known(c: Column) -> Column:
        return F.when(F.col("has_shifts"), c)

    for where, label in ((on, "OnIce"), (off, "OffIce")):
        for side, mark in ((lambda k, w=where: w("own", k), "F"), (lambda k, w=where: against(w, k), "A")):
            columns += [
                known(side("saved") + side("goals")).alias(f"{label}_{mark}_shotsOnGoal"),
                known(side("missed")).alias(f"{label}_{mark}_missedShots"),
                known(side("blocked")).alias(f"{label}_{mark}_blockedShotAttempts"),
                known(side("goals")).alias(f"{label}_{mark}_goals"),
                known(side("saved") + side("goals") + side("missed") + side("blocked")).alias(
                    f"{label}_{mark}_shotAttempts"
                ),
                known(side("saved") + side("goals") + side("missed")).alias(f"{label}_{mark}_unblockedShotAttempts"),
            ]
    for where, label in ((on, "onIce"), (off, "offIce")):
        free_own = where("own", "saved") + where("own", "goals") + where("own", "missed")
        free_other = where("other", "saved") + where("other", "goals") + where("other", "missed")
        all_own, all_other = free_own + where("own", "blocked"), free_other + where("other", "blocked")
        columns += [
            known(percent_share(all_own, all_own, all_other)).alias(f"{label}_corsiPercentage"),
            known(percent_share(free_own, free_own, free_other)).alias(f"{label}_fenwickPercentage"),
        ]
    free_own = on("own", "saved") + on("own", "goals") + on("own", "missed")
    free_all = against(on, "saved") + against(on, "goals") + against(on, "missed")
    columns += [
        known(percent_share(free_own + on("own", "blocked"), free_own + on("own", "blocked"), free_all + against(on, "blocked"))).alias("corsiPercentage"),
        known(percent_share(free_own, free_own, free_all)).alias("fenwickPercentage"),
    ]
    return columns
