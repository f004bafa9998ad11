"""Play-event operators over the ``events`` table.

Each day is a game between team A (even users, at home) and team B. Event types
stand for play types, ``k`` and ``value`` give coordinates, skater code and
zone, and a quarter of the day is a period.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions.play import game_seconds, shot_danger, strength_flag
from formline.functions.text import lookup_code
from formline.operators.events import (
    games_of,
    individual_counts,
    player_stats,
    possession,
    rebounds_and_zones,
    team_counts,
    team_stats,
)
from formline.operators.matching import first_within_tolerance, inside_any_interval, merge_intervals, totals_inside
from formline.plans.star.registry import query, r2, row_bound, table

PLAY_TYPES = {"view": "shot-on-goal", "purchase": "goal", "click": "missed-shot", "error": "blocked-shot", "signup": "hit"}
CODES = {"0": "1551", "1": "1451", "2": "1541"}
ZONES = {"0": "O", "1": "N", "2": "D"}

PLAYS_SQL = """
base AS (SELECT *, CAST(props::JSON->>'k' AS INTEGER) AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS game_id,
  CAST(EXTRACT(hour FROM ts) AS INTEGER) * 3600 + CAST(EXTRACT(minute FROM ts) AS INTEGER) * 60 + CAST(FLOOR(EXTRACT(second FROM ts)) AS INTEGER) AS s FROM events),
plays AS (SELECT game_id, event_id AS event_index, user_id AS player, k, value,
  CASE event_type WHEN 'view' THEN 'shot-on-goal' WHEN 'purchase' THEN 'goal' WHEN 'click' THEN 'missed-shot' WHEN 'error' THEN 'blocked-shot' ELSE 'hit' END AS type,
  CAST(s // 21600 + 1 AS INTEGER) AS period, s % 21600 AS sec,
  CASE k % 4 WHEN 0 THEN '1551' WHEN 1 THEN '1451' WHEN 2 THEN '1541' END AS code,
  CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS owner, CAST(k AS DOUBLE) AS x, value % 60 - 30 AS y,
  CASE k % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'N' ELSE 'D' END AS zone FROM base),
classed AS (SELECT *, SQRT((x - 89) * (x - 89) + y * y) AS dist, CASE WHEN x = 89 THEN 0 ELSE ABS(DEGREES(ATAN2(y, 89 - x))) END AS ang FROM plays),
graded AS (SELECT *, CASE WHEN dist <= 15 AND ang <= 35 THEN 'high' WHEN dist <= 35 AND ang <= 50 THEN 'medium' ELSE 'low' END AS danger FROM classed),
sided AS (
  SELECT *, 'A' AS team_id, owner = 'A' AS own, CASE code WHEN '1451' THEN '5on4' WHEN '1541' THEN '4on5' ELSE '5on5' END AS situation FROM graded
  UNION ALL
  SELECT *, 'B', owner = 'B', CASE code WHEN '1451' THEN '4on5' WHEN '1541' THEN '5on4' ELSE '5on5' END FROM graded),
listed AS (SELECT *, situation AS sit FROM sided UNION ALL SELECT *, 'all' FROM sided)
"""


def plays(spark, folder):
    events = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    in_period = F.pmod(seconds, F.lit(21600))
    return events.select(
        F.to_date("ts").cast("string").alias("game_id"),
        F.lit("A").alias("home_id"),
        F.lit("B").alias("away_id"),
        F.col("event_id").alias("event_index"),
        lookup_code("event_type", PLAY_TYPES).alias("type"),
        (F.floor(seconds / 21600) + 1).cast("int").alias("period"),
        F.format_string("%02d:%02d", F.floor(in_period / 60).cast("int"), F.pmod(in_period, F.lit(60))).alias("clock"),
        in_period.alias("sec"),
        lookup_code(F.pmod(k, F.lit(4)).cast("string"), CODES, None).alias("code"),
        F.when(F.pmod("user_id", F.lit(2)) == 0, "A").otherwise("B").alias("owner_id"),
        F.col("user_id").cast("string").alias("player_id"),
        k.cast("double").alias("x"),
        (F.col("value") % 60 - 30).alias("y"),
        lookup_code(F.pmod(k, F.lit(3)).cast("string"), ZONES).alias("zone"),
    )


def _count(condition, name):
    return f'CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS "{name}"'


_SHOT = "type IN ('shot-on-goal', 'goal')"
_TEAM = ", ".join(
    [
        _count(f"own AND {_SHOT}", "shotsOnGoalFor"),
        _count(f"NOT own AND {_SHOT}", "shotsOnGoalAgainst"),
        _count("own AND type = 'goal'", "goalsFor"),
        _count("NOT own AND type = 'missed-shot'", "missedShotsAgainst"),
        _count("own AND type = 'blocked-shot'", "blockedShotAttemptsFor"),
        _count("own AND type = 'hit'", "hitsFor"),
        _count(f"own AND {_SHOT} AND danger = 'high'", "highDangerShotsFor"),
        _count("NOT own AND type = 'goal' AND danger = 'medium'", "mediumDangerGoalsAgainst"),
        _count("own AND type <> 'hit'", "shotAttemptsFor"),
        _count("NOT own AND type = 'shot-on-goal'", "savedShotsOnGoalAgainst"),
    ]
)


@query(
    "event_counts_for_against",
    f"WITH {PLAYS_SQL} SELECT game_id, team_id, sit AS situation, {_TEAM} FROM listed GROUP BY game_id, team_id, sit",
)
def event_counts(spark, folder):
    return team_counts(plays(spark, folder)).select(
        "game_id",
        "team_id",
        "situation",
        "shotsOnGoalFor",
        "shotsOnGoalAgainst",
        "goalsFor",
        "missedShotsAgainst",
        "blockedShotAttemptsFor",
        "hitsFor",
        "highDangerShotsFor",
        "mediumDangerGoalsAgainst",
        "shotAttemptsFor",
        "savedShotsOnGoalAgainst",
    )


_PCT = "100.0 * SUM(CASE WHEN own THEN 1 ELSE 0 END) / COUNT(*)"


@query(
    "possession_pct",
    f"""
    WITH {PLAYS_SQL}
    SELECT game_id, team_id, sit AS situation, {r2(_PCT)} AS "corsiPercentage",
      COALESCE({r2("100.0 * SUM(CASE WHEN own AND type <> 'blocked-shot' THEN 1 ELSE 0 END) / NULLIF(SUM(CASE WHEN type <> 'blocked-shot' THEN 1 ELSE 0 END), 0)")}, 50.0) AS "fenwickPercentage"
    FROM listed WHERE type <> 'hit' GROUP BY game_id, team_id, sit""",
)
def possession_pct(spark, folder):
    return possession(plays(spark, folder))


@query(
    "danger_class",
    f"""WITH {PLAYS_SQL} SELECT event_index, danger, CASE situation WHEN '5on4' THEN 'PP' WHEN '4on5' THEN 'PK' ELSE 'EV' END AS strength,
      CASE WHEN period <= 3 THEN (period - 1) * 1200 + 1200 - sec ELSE 3600 + 300 - sec END AS game_second FROM sided WHERE team_id = 'A'""",
)
def danger_class(spark, folder):
    p = plays(spark, folder)
    return p.select(
        "event_index",
        shot_danger("x", "y").alias("danger"),
        strength_flag("code", F.lit(True)).alias("strength"),
        game_seconds("period", "clock").alias("game_second"),
    )


_SEQUENCE = "PARTITION BY game_id, team_id, sit ORDER BY event_index"


@query(
    "rebounds",
    f"""
    WITH {PLAYS_SQL},
    f AS (SELECT *, CASE WHEN {_SHOT} AND LAG(type) OVER w IN ('shot-on-goal', 'goal') AND LAG(owner) OVER w = owner AND LAG(period) OVER w = period
      AND ABS(sec - LAG(sec) OVER w) <= 3 THEN 1 ELSE 0 END AS rb FROM listed WINDOW w AS ({_SEQUENCE}))
    SELECT game_id, team_id, sit AS situation, {_count("own AND rb = 1", "reboundsFor")}, {_count("own AND rb = 1 AND type = 'goal'", "reboundGoalsFor")},
      {_count("NOT own AND rb = 1", "reboundsAgainst")}, {_count("NOT own AND rb = 1 AND type = 'goal'", "reboundGoalsAgainst")}
    FROM f GROUP BY game_id, team_id, sit""",
)
def rebounds(spark, folder):
    found = rebounds_and_zones(plays(spark, folder), bounded_by=row_bound(spark, folder, "events", 4))
    return found.select("game_id", "team_id", "situation", "reboundsFor", "reboundGoalsFor", "reboundsAgainst", "reboundGoalsAgainst")


@query(
    "zone_continuation",
    f"""
    WITH {PLAYS_SQL},
    f AS (SELECT *, LEAD(owner) OVER w = owner AS same, LEAD(zone) OVER w AS nz FROM listed WINDOW w AS ({_SEQUENCE}))
    SELECT game_id, team_id, sit AS situation, {_count("own AND same AND nz = zone", "playContinuedInZoneFor")}, {_count("own AND same AND nz <> zone", "playContinuedOutsideZoneFor")},
      {_count("NOT own AND same AND nz = zone", "playContinuedInZoneAgainst")}
    FROM f GROUP BY game_id, team_id, sit""",
)
def zone_continuation(spark, folder):
    found = rebounds_and_zones(plays(spark, folder), bounded_by=row_bound(spark, folder, "events", 4))
    return found.select(
        "game_id", "team_id", "situation", "playContinuedInZoneFor", "playContinuedOutsideZoneFor", "playContinuedInZoneAgainst"
    )


@query(
    "team_game_stats",
    f"""
    WITH {PLAYS_SQL}, games AS (SELECT DISTINCT game_id FROM plays), sits AS (SELECT UNNEST(['all', '5on4', '4on5', '5on5']) AS sit),
    teams AS (SELECT UNNEST(['A', 'B']) AS team_id)
    SELECT g.game_id, t.team_id, CASE WHEN t.team_id = 'A' THEN 1 ELSE 0 END AS is_home, s.sit AS situation, CAST(COALESCE(c.n, 0) AS BIGINT) AS "shotsOnGoalFor"
    FROM games g CROSS JOIN teams t CROSS JOIN sits s
    LEFT JOIN (SELECT game_id, team_id, sit, SUM(CASE WHEN own AND {_SHOT} THEN 1 ELSE 0 END) AS n FROM listed GROUP BY ALL) c
    ON g.game_id = c.game_id AND t.team_id = c.team_id AND s.sit = c.sit""",
)
def team_game_stats(spark, folder):
    return team_stats(plays(spark, folder), bounded_by=row_bound(spark, folder, "events", 4)).select(
        "game_id", "team_id", F.col("is_home").cast("int").alias("is_home"), "situation", "shotsOnGoalFor"
    )


def _shifts_of_users(spark, folder):
    """A user is on for 40 minutes from each of their sign-ups, within the
    quarter of the day."""
    p = plays(spark, folder).filter("type = 'hit'")
    end = F.least(F.col("sec") + 2400, F.lit(21599))
    return p.select("game_id", "player_id", "period", F.col("sec").alias("s0"), end.alias("s1"))


_SHIFTS = "shifts AS (SELECT game_id, player, period, sec AS s0, LEAST(sec + 2400, 21599) AS s1 FROM plays WHERE type = 'hit')"


@query(
    "events_in_interval",
    f"""
    WITH {PLAYS_SQL}, {_SHIFTS}
    SELECT event_index, CASE WHEN EXISTS (SELECT 1 FROM shifts s WHERE s.game_id = p.game_id AND s.player = p.player AND s.period = p.period
      AND p.sec BETWEEN s.s0 AND s.s1) THEN 1 ELSE 0 END AS inside FROM plays p""",
)
def events_in_interval(spark, folder):
    p = plays(spark, folder)
    flagged = inside_any_interval(
        p, _shifts_of_users(spark, folder), ["game_id", "player_id", "period"], "sec", "s0", "s1",
        bounded_by=row_bound(spark, folder, "events", 3),
    )
    return flagged.select("event_index", "inside")


@query(
    "merged_intervals",
    f"""
    WITH {PLAYS_SQL}, {_SHIFTS},
    m AS (SELECT *, MAX(s1) OVER (PARTITION BY game_id, player, period ORDER BY s0, s1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM shifts),
    i AS (SELECT *, SUM(CASE WHEN reach IS NULL OR s0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, player, period ORDER BY s0, s1 ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT game_id, CAST(player AS VARCHAR) AS player_id, period, MIN(s0) AS s0, MAX(s1) AS s1 FROM i GROUP BY game_id, player, period, island""",
)
def merged_intervals(spark, folder):
    return merge_intervals(_shifts_of_users(spark, folder), ["game_id", "player_id", "period"], "s0", "s1", row_bound(spark, folder, "events"))


@query(
    "totals_in_intervals",
    f"""
    WITH {PLAYS_SQL}, {_SHIFTS},
    hit AS (SELECT DISTINCT s.game_id, s.player, p.event_index, p.owner FROM shifts s JOIN plays p ON s.game_id = p.game_id AND s.period = p.period AND p.sec BETWEEN s.s0 AND s.s1)
    SELECT game_id, CAST(player AS VARCHAR) AS player_id, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(CASE WHEN owner = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS n_home FROM hit GROUP BY game_id, player""",
)
def totals_in_intervals(spark, folder):
    p = plays(spark, folder).withColumn("n", F.lit(1)).withColumn("n_home", (F.col("owner_id") == "A").cast("int"))
    sums = totals_inside(
        p, _shifts_of_users(spark, folder), ["game_id", "period"], ["player_id"], "sec", "s0", "s1", ["n", "n_home"],
        bounded_by=row_bound(spark, folder, "events", 3),
    )
    return sums.groupBy("game_id", "player_id").agg(F.sum("n").alias("n"), F.sum("n_home").alias("n_home"))


@query(
    "first_within_tolerance",
    f"""
    WITH {PLAYS_SQL}
    SELECT a.event_index, COALESCE((SELECT b.type FROM plays b WHERE b.game_id = a.game_id AND b.period = a.period AND b.type <> 'hit' AND ABS(b.sec - a.sec) < 90
      ORDER BY b.event_index LIMIT 1), 'none') AS near_type FROM plays a WHERE a.type = 'hit'""",
)
def first_near(spark, folder):
    p = plays(spark, folder)
    points = p.filter("type = 'hit'").select("event_index", "game_id", "period", "sec")
    others = p.filter("type <> 'hit'").select("game_id", "period", "sec", "type", "event_index")
    matched = first_within_tolerance(
        points, others, ["game_id", "period"], "sec", "event_index", "type", 90, "near_type", "none"
    )
    return matched.select("event_index", "near_type")


@query(
    "player_event_counts",
    f"""
    WITH {PLAYS_SQL}
    SELECT game_id, CAST(player AS VARCHAR) AS player_id, code, {_count("type = 'goal'", "I_F_goals")}, {_count(_SHOT, "I_F_shotsOnGoal")},
      {_count("type = 'hit'", "I_F_hits")}, {_count(f"{_SHOT} AND danger = 'low'", "I_F_lowDangerShots")} FROM graded GROUP BY game_id, player, code""",
)
def player_counts(spark, folder):
    counted = individual_counts(_acting(plays(spark, folder)))
    return counted.select("game_id", "player_id", "code", "I_F_goals", "I_F_shotsOnGoal", "I_F_hits", "I_F_lowDangerShots")


def _acting(p):
    """The user of an event as its actor, by type."""
    def when(*types):
        return F.when(F.col("type").isin(*types), F.col("player_id"))

    none = F.lit(None).cast("string")
    return p.select(
        "*",
        when("shot-on-goal", "missed-shot", "blocked-shot", "goal").alias("shooter_id"),
        when("goal").alias("scorer_id"),
        none.alias("assist1_id"),
        none.alias("assist2_id"),
        when("hit").alias("hitter_id"),
        none.alias("actor_id"),
    ).drop("player_id")


def _player_stats(spark, folder):
    p = plays(spark, folder)
    roster = p.select("game_id", "player_id", (F.col("owner_id") == "A").alias("is_home")).distinct()

    def clock(c):
        return F.format_string("%02d:%02d", F.floor(c / 60).cast("int"), F.pmod(c, F.lit(60)))

    shifts = _shifts_of_users(spark, folder).select(
        "game_id",
        "player_id",
        "period",
        clock(F.col("s0")).alias("startTime"),
        clock(F.col("s1")).alias("endTime"),
        clock(F.col("s1") - F.col("s0")).alias("duration"),
    )
    return player_stats(_acting(p), shifts, roster, bounded_by=row_bound(spark, folder, "events", 25))


_ON = """SELECT DISTINCT s.game_id, s.player, p.event_index, p.owner, p.type,
  CASE WHEN s.player % 2 = 0 THEN CASE code WHEN '1451' THEN '5on4' WHEN '1541' THEN '4on5' ELSE '5on5' END
       ELSE CASE code WHEN '1451' THEN '4on5' WHEN '1541' THEN '5on4' ELSE '5on5' END END AS sit,
  (p.owner = 'A') = (s.player % 2 = 0) AS own
  FROM shifts s JOIN plays p ON s.game_id = p.game_id AND s.period = p.period AND p.sec BETWEEN s.s0 AND s.s1 AND p.type <> 'hit'"""


@query(
    "player_game_stats",
    f"""
    WITH {PLAYS_SQL}, {_SHIFTS}, oni AS ({_ON}), onl AS (SELECT *, 'all' AS s2 FROM oni UNION ALL SELECT *, sit FROM oni),
    roster AS (SELECT DISTINCT game_id, player FROM plays), sits AS (SELECT UNNEST(['all', '5on4', '4on5', '5on5']) AS s2),
    agg AS (SELECT game_id, player, s2, SUM(CASE WHEN own AND {_SHOT} THEN 1 ELSE 0 END) AS f, SUM(CASE WHEN NOT own AND {_SHOT} THEN 1 ELSE 0 END) AS a,
      SUM(CASE WHEN own THEN 1 ELSE 0 END) AS cf, COUNT(*) AS n FROM onl GROUP BY game_id, player, s2),
    ice AS (SELECT game_id, player, SUM(s1 - s0) AS t, COUNT(*) AS c FROM shifts GROUP BY game_id, player)
    SELECT r.game_id, CAST(r.player AS VARCHAR) AS player_id, s.s2 AS situation, CAST(COALESCE(f, 0) AS BIGINT) AS "OnIce_F_shotsOnGoal",
      CAST(COALESCE(a, 0) AS BIGINT) AS "OnIce_A_shotsOnGoal", COALESCE({r2("100.0 * cf / n")}, 50.0) AS "onIce_corsiPercentage",
      CASE WHEN s.s2 = 'all' THEN CAST(COALESCE(t, 0) AS DOUBLE) END AS total_icetime, CASE WHEN s.s2 = 'all' THEN CAST(COALESCE(c, 0) AS BIGINT) END AS total_shifts
    FROM roster r CROSS JOIN sits s LEFT JOIN agg g ON r.game_id = g.game_id AND r.player = g.player AND s.s2 = g.s2
    LEFT JOIN ice i ON r.game_id = i.game_id AND r.player = i.player""",
)
def player_game_stats(spark, folder):
    stats = _player_stats(spark, folder)
    whole = F.col("situation") == "all"
    return stats.select(
        "game_id",
        "player_id",
        "situation",
        "OnIce_F_shotsOnGoal",
        "OnIce_A_shotsOnGoal",
        "onIce_corsiPercentage",
        F.when(whole, F.col("icetime")).alias("total_icetime"),
        F.when(whole, F.col("shifts")).alias("total_shifts"),
    )


_WIDE_KINDS = {
    "shotsOnGoal": _SHOT, "goals": "type = 'goal'", "missedShots": "type = 'missed-shot'", "blockedShotAttempts": "type = 'blocked-shot'", "hits": "type = 'hit'",
    **{f"{d}DangerShots": f"{_SHOT} AND danger = '{d}'" for d in ("high", "medium", "low")},
    **{f"{d}DangerGoals": f"type = 'goal' AND danger = '{d}'" for d in ("high", "medium", "low")},
    "shotAttempts": "type <> 'hit'", "unblockedShotAttempts": "type NOT IN ('hit', 'blocked-shot')", "savedShotsOnGoal": "type = 'shot-on-goal'",
    "savedUnblockedShotAttempts": "type IN ('shot-on-goal', 'missed-shot')",
}
_WIDE = {f"{name}{side}": f"{own} AND {kind}" for side, own in (("For", "own"), ("Against", "NOT own")) for name, kind in _WIDE_KINDS.items()}


@query(
    "event_counts_wide",
    f"WITH {PLAYS_SQL} SELECT game_id, team_id, sit AS situation, {', '.join(_count(c, n) for n, c in _WIDE.items())} FROM listed GROUP BY game_id, team_id, sit",
)
def event_counts_wide(spark, folder):
    """Every counter and danger class of both sides."""
    return team_counts(plays(spark, folder)).select("game_id", "team_id", "situation", *_WIDE)


_ICE = {
    "shotsOnGoal": _SHOT, "missedShots": "type = 'missed-shot'", "blockedShotAttempts": "type = 'blocked-shot'", "goals": "type = 'goal'",
    "shotAttempts": "TRUE", "unblockedShotAttempts": "type <> 'blocked-shot'",
}
_ICE_NAMES = {f"{where}_{mark}_{name}": (where, own, kind) for where in ("OnIce", "OffIce") for mark, own in (("F", "own"), ("A", "NOT own")) for name, kind in _ICE.items()}
_OWN_COUNTS = {
    "I_F_goals": "type = 'goal'", "I_F_shotsOnGoal": _SHOT, "I_F_missedShots": "type = 'missed-shot'", "I_F_blockedShotAttempts": "type = 'blocked-shot'",
    "I_F_hits": "type = 'hit'", **{f"I_F_{d}DangerShots": f"{_SHOT} AND danger = '{d}'" for d in ("high", "medium", "low")},
    **{f"I_F_{d}DangerGoals": f"type = 'goal' AND danger = '{d}'" for d in ("high", "medium", "low")}, "I_F_shotAttempts": "type <> 'hit'",
}


def _sums(table_name, names):
    return ", ".join(f'COALESCE(SUM(CASE WHEN {c} THEN 1 ELSE 0 END), 0) AS "{n}"' for n, c in names) + f" FROM {table_name}"


_MINE = "CASE WHEN p.player % 2 = 0 THEN CASE code WHEN '1451' THEN '5on4' WHEN '1541' THEN '4on5' ELSE '5on5' END ELSE CASE code WHEN '1451' THEN '4on5' WHEN '1541' THEN '5on4' ELSE '5on5' END END"


@query(
    "player_game_stats_wide",
    f"""
    WITH {PLAYS_SQL}, {_SHIFTS}, oni AS ({_ON}), onl AS (SELECT *, 'all' AS s2 FROM oni UNION ALL SELECT *, sit FROM oni),
    roster AS (SELECT DISTINCT game_id, player FROM plays), sits AS (SELECT UNNEST(['all', '5on4', '4on5', '5on5']) AS s2),
    alli AS (SELECT r.game_id, r.player, q.type, (q.owner = 'A') = (r.player % 2 = 0) AS own, {_MINE.replace("p.player", "r.player")} AS sit
      FROM roster r JOIN plays q ON r.game_id = q.game_id AND q.type <> 'hit'),
    alll AS (SELECT *, 'all' AS s2 FROM alli UNION ALL SELECT *, sit FROM alli),
    mine AS (SELECT *, {_MINE} AS sit FROM graded p), minel AS (SELECT *, 'all' AS s2 FROM mine UNION ALL SELECT *, sit FROM mine),
    onc AS (SELECT game_id, player, s2, {_sums("onl", [(n, f"{own} AND {kind}") for n, (w, own, kind) in _ICE_NAMES.items() if w == "OnIce"])} GROUP BY 1, 2, 3),
    allc AS (SELECT game_id, player, s2, {_sums("alll", [(n, f"{own} AND {kind}") for n, (w, own, kind) in _ICE_NAMES.items() if w == "OffIce"])} GROUP BY 1, 2, 3),
    own AS (SELECT game_id, player, s2, {_sums("minel", _OWN_COUNTS.items())} GROUP BY 1, 2, 3),
    held AS (SELECT DISTINCT game_id FROM shifts),
    placed AS (SELECT s.game_id, s.player, s.s1 - s.s0 AS t, (SELECT arg_min(COALESCE(code, '1551'), p.event_index) FROM plays p WHERE p.game_id = s.game_id AND p.period = s.period AND p.sec BETWEEN s.s0 - 4 AND s.s0 + 4) AS code FROM shifts s),
    icel AS (SELECT game_id, player, t, 'all' AS s2 FROM placed UNION ALL SELECT game_id, player, t, {_MINE.replace("p.player", "player")} FROM placed),
    ice AS (SELECT game_id, player, s2, SUM(t) AS t, COUNT(*) AS c FROM icel GROUP BY 1, 2, 3)
    SELECT r.game_id, CAST(r.player AS VARCHAR) AS player_id, s.s2 AS situation, CAST(COALESCE(ice.t, 0) AS DOUBLE) AS icetime, CAST(COALESCE(ice.c, 0) AS BIGINT) AS shifts,
      {", ".join(f'CAST(COALESCE(own."{n}", 0) AS BIGINT) AS "{n}"' for n in _OWN_COUNTS)},
      {", ".join(f'CASE WHEN held.game_id IS NOT NULL THEN CAST(COALESCE(onc."{n}", 0) AS BIGINT) END AS "{n}"' for n, x in _ICE_NAMES.items() if x[0] == "OnIce")},
      {", ".join(f'CASE WHEN held.game_id IS NOT NULL THEN CAST(COALESCE(allc."{n}", 0) - COALESCE(onc."{n.replace("OffIce", "OnIce")}", 0) AS BIGINT) END AS "{n}"' for n, x in _ICE_NAMES.items() if x[0] == "OffIce")}
    FROM roster r CROSS JOIN sits s LEFT JOIN held ON r.game_id = held.game_id LEFT JOIN onc ON r.game_id = onc.game_id AND r.player = onc.player AND s.s2 = onc.s2
    LEFT JOIN allc ON r.game_id = allc.game_id AND r.player = allc.player AND s.s2 = allc.s2 LEFT JOIN own ON r.game_id = own.game_id AND r.player = own.player AND s.s2 = own.s2
    LEFT JOIN ice ON r.game_id = ice.game_id AND r.player = ice.player AND s.s2 = ice.s2""",
)
def player_game_stats_wide(spark, folder):
    """Own counters, on-ice and off-ice attempts of both sides, and the ice time of each situation."""
    stats = _player_stats(spark, folder)
    return stats.select("game_id", "player_id", "situation", "icetime", "shifts", *_OWN_COUNTS, *_ICE_NAMES)


@query("games_of_events", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS game_id, 'A' AS home_id, 'B' AS away_id FROM events")
def games_seen(spark, folder):
    return games_of(plays(spark, folder), ["game_id"])


@query(
    "json_props_extract",
    "SELECT event_id, event_type, CAST(props::JSON->>'k' AS INTEGER) AS k FROM events",
)
def json_props(spark, folder):
    events = table(spark, folder, "events")
    parsed = F.from_json("props", "k int")
    return events.select("event_id", "event_type", parsed.k.alias("k"))
