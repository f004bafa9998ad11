"""The serving queries over the star tables.

Games between nations (see ``registry``) are the team games; the lines of an
order are its player rows: a part is a player of the home nation, quantity its
shots, tax percent its goals, discount percent its assists. Open orders are
upcoming, with a null game id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators.streaks import current_streak, hit_rates_last_n
from formline.plans import reports
from formline.plans.star.registry import GAMES_SQL, nation_games, nation_pairs, query, r2, slate_sql, table, text

TODAY = "2001-06-15"


def team_games(spark, folder):
    """Played games, one row per team, under the serving column names."""
    return nation_games(spark, folder).filter("status <> 'O'").select(
        F.col("game").alias("gameId"),
        F.col("d").alias("gameDate"),
        F.col("team").alias("playerTeam"),
        F.col("opponent").alias("opposingTeam"),
        F.col("side").alias("home_or_away"),
        F.col("pointsFor").alias("goals"),
        F.col("pointsAgainst").alias("goalsAllowed"),
        (F.col("pointsFor") % 40).alias("shots"),
        (F.col("pointsAgainst") % 40).alias("shotsAllowed"),
    )


TEAM_SQL = f"""{GAMES_SQL},
tg AS (SELECT game AS "gameId", d AS "gameDate", team AS "playerTeam", opponent AS "opposingTeam", side AS home_or_away, pointsFor AS goals, pointsAgainst AS "goalsAllowed",
  pointsFor % 40 AS shots, pointsAgainst % 40 AS "shotsAllowed" FROM games WHERE status <> 'O')"""


def player_games(spark, folder):
    """One row per (order, part) with summed values."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").cast("long").alias("shots"),
        F.sum(F.round(F.col("l_tax") * 100)).cast("long").alias("goals"),
        F.sum(F.round(F.col("l_discount") * 100)).cast("long").alias("assists"),
    )
    games = nation_pairs(spark, folder)
    joined = lines.join(games, F.col("l_orderkey") == F.col("game"))
    return joined.select(
        F.when(F.col("status") != "O", F.col("game")).alias("gameId"),
        F.col("game").alias("order"),
        F.col("d").alias("gameDate"),
        F.col("l_partkey").alias("playerId"),
        F.col("home").alias("playerTeam"),
        F.col("away").alias("opposingTeam"),
        "shots",
        "goals",
        "assists",
    )


PLAYER_SQL = f"""{TEAM_SQL},
pl AS (SELECT l_orderkey, l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS shots, CAST(SUM(ROUND(l_tax * 100)) AS BIGINT) AS goals, CAST(SUM(ROUND(l_discount * 100)) AS BIGINT) AS assists
  FROM lineitem GROUP BY l_orderkey, l_partkey),
pg AS (SELECT CASE WHEN status <> 'O' THEN game END AS "gameId", game AS "order", d AS "gameDate", l_partkey AS "playerId", home AS "playerTeam", away AS "opposingTeam", shots, goals, assists
  FROM pl JOIN pairs ON l_orderkey = game)"""


def predictions(spark, folder):
    """Prediction rows derived from the player rows."""
    rows = player_games(spark, folder)
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("playerId"), F.col("p_name").alias("shooterName"))
    return rows.join(part, "playerId").select(
        "*",
        (F.col("shots") + F.col("goals") * 0.25).alias("predictedSOG"),
        F.col("shots").cast("double").alias("avg_last7"),
        ((F.col("shots") + F.col("goals")) * 0.5).alias("avg_last3"),
        F.col("goals").cast("double").alias("last_value"),
        (F.col("assists") / 100.0).alias("hit_rate_2plus"),
        (F.col("goals") / 100.0).alias("hit_rate_3plus"),
        F.abs(F.col("goals") * 0.25).alias("abs_gap"),
    )


PREDICTION_SQL = f"""{PLAYER_SQL},
pr AS (SELECT pg.*, p_name AS "shooterName", CAST(shots + goals * 0.25 AS DOUBLE) AS "predictedSOG", CAST(shots AS DOUBLE) AS avg_last7, CAST((shots + goals) * 0.5 AS DOUBLE) AS avg_last3, CAST(goals AS DOUBLE) AS last_value,
  CAST(assists / 100.0 AS DOUBLE) AS hit_rate_2plus, CAST(goals / 100.0 AS DOUBLE) AS hit_rate_3plus, CAST(ABS(goals * 0.25) AS DOUBLE) AS abs_gap FROM pg JOIN part ON "playerId" = p_partkey)"""


@query(
    "top_k_teams",
    f"""
    WITH {TEAM_SQL},
    b AS (SELECT MAX("gameDate") AS best FROM tg WHERE (shots > 0 OR "shotsAllowed" > 0) AND "gameDate" BETWEEN DATE '2001-08-10' - INTERVAL 14 DAY AND DATE '2001-08-10'),
    day AS (SELECT tg.* FROM tg JOIN b ON "gameDate" = best WHERE shots > 0 OR "shotsAllowed" > 0),
    m AS (SELECT 'made' AS kind, "playerTeam" AS team, CAST(SUM(shots) AS BIGINT) AS total, CAST("gameDate" AS VARCHAR) AS effective_date FROM day GROUP BY 2, "gameDate"),
    a AS (SELECT 'allowed' AS kind, "playerTeam" AS team, CAST(SUM("shotsAllowed") AS BIGINT) AS total, CAST("gameDate" AS VARCHAR) AS effective_date FROM day GROUP BY 2, "gameDate")
    SELECT * FROM (SELECT * FROM m ORDER BY total DESC, team LIMIT 3) x UNION ALL SELECT * FROM (SELECT * FROM a ORDER BY total DESC, team LIMIT 3) y""",
)
def top_k_teams(spark, folder):
    return reports.team_rankings(team_games(spark, folder), "2001-08-10", "shots", "shotsAllowed", k=3, lookback=14)


@query(
    "top_teams_overall",
    f"""WITH {TEAM_SQL} SELECT "playerTeam", CAST(SUM(goals) AS BIGINT) AS total FROM tg GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_overall(spark, folder):
    return reports.top_teams(team_games(spark, folder), "playerTeam", "goals", "total")


_RANKS = """
g AS (SELECT "playerTeam", "gameId", MAX(COALESCE(shots, 0)) AS s, MAX(COALESCE("shotsAllowed", 0)) AS a FROM tg GROUP BY 1, 2),
t AS (SELECT "playerTeam", ROUND(CAST(AVG(s) AS DECIMAL(18,6)), 6) AS avg_made, ROUND(CAST(AVG(a) AS DECIMAL(18,6)), 6) AS avg_allowed, COUNT(*) AS games FROM g GROUP BY 1 HAVING COUNT(*) >= 5),
ranks AS (SELECT "playerTeam", CAST(avg_made AS DOUBLE) AS avg_made, CAST(avg_allowed AS DOUBLE) AS avg_allowed, games,
  ROUND(CAST(COUNT(*) OVER () - ROW_NUMBER() OVER (ORDER BY avg_made DESC, "playerTeam") AS DOUBLE) / (COUNT(*) OVER () - 1), 4) AS avg_made_pct,
  ROUND(CAST(COUNT(*) OVER () - ROW_NUMBER() OVER (ORDER BY avg_allowed DESC, "playerTeam") AS DOUBLE) / (COUNT(*) OVER () - 1), 4) AS avg_allowed_pct FROM t)"""


def rank_map(spark, folder):
    return reports.season_rank_map(
        team_games(spark, folder), "playerTeam", "gameId", {"shots": "avg_made", "shotsAllowed": "avg_allowed"}
    )


@query("season_rank_map", f"WITH {TEAM_SQL}, {_RANKS} SELECT * FROM ranks")
def season_rank_map(spark, folder):
    return rank_map(spark, folder)


@query(
    "season_averages",
    f"""WITH {TEAM_SQL}, g AS (SELECT "playerTeam", "gameId", MAX(shots) AS s FROM tg GROUP BY 1, 2)
    SELECT "playerTeam", {r2("AVG(s)", 1)} AS avg_shots, COUNT(*) AS games FROM g GROUP BY 1 HAVING COUNT(*) >= 5 AND AVG(s) > 0""",
)
def averages(spark, folder):
    games = team_games(spark, folder)
    return reports.season_averages_with_fallback(
        games, games, "playerTeam", "gameId", "gameDate", "shots", "shots", "avg_shots"
    )


@query(
    "leaderboard",
    f"""
    WITH {PREDICTION_SQL},
    b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "shooterName", "playerTeam" ORDER BY "predictedSOG" DESC, "playerId") AS rn FROM pr
      WHERE "gameId" IS NULL AND hit_rate_2plus > 0 AND avg_last7 > 0),
    o AS (SELECT "shooterName", "playerTeam", {r2('"predictedSOG"')} AS predicted, {r2("hit_rate_2plus * 100", 1)} AS hit_rate_2plus FROM b WHERE rn = 1)
    SELECT * FROM o ORDER BY hit_rate_2plus DESC, "shooterName", "playerTeam" LIMIT 40""",
)
def leaderboard(spark, folder):
    board = reports.hit_rate_leaderboard(predictions(spark, folder), TODAY)
    return board.select("shooterName", "playerTeam", "predicted", "hit_rate_2plus")


@query(
    "filter_options",
    f"""WITH {TEAM_SQL} SELECT "playerTeam" AS option FROM tg UNION SELECT "opposingTeam" FROM tg""",
)
def options(spark, folder):
    return reports.filter_options(team_games(spark, folder), ["playerTeam", "opposingTeam"])


@query(
    "repair_scores",
    f"""
    WITH {TEAM_SQL}, z AS (SELECT "gameId", "playerTeam", "opposingTeam", CASE WHEN "gameId" % 3 = 0 THEN 0 ELSE goals END AS goals, CASE WHEN "gameId" % 3 = 0 THEN 0 ELSE "goalsAllowed" END AS ga FROM tg),
    s AS (SELECT "gameId", "playerTeam", CASE WHEN "gameId" % 2 = 0 THEN goals END AS total FROM tg),
    f AS (SELECT z.*, z.goals = 0 AND z.ga = 0 AND o.total IS NOT NULL AND p.total IS NOT NULL AS rep, o.total AS o, p.total AS p FROM z LEFT JOIN s o ON z."gameId" = o."gameId" AND z."playerTeam" = o."playerTeam"
      LEFT JOIN s p ON z."gameId" = p."gameId" AND z."opposingTeam" = p."playerTeam")
    SELECT "gameId", "playerTeam", "opposingTeam", CASE WHEN rep THEN o ELSE goals END AS goals, CASE WHEN rep THEN p ELSE ga END AS "goalsAllowed",
      CASE WHEN CASE WHEN rep THEN o ELSE goals END > CASE WHEN rep THEN p ELSE ga END THEN 'Yes' ELSE 'No' END AS "isWin" FROM f""",
)
def repaired(spark, folder):
    games = team_games(spark, folder).select("gameId", "playerTeam", "opposingTeam", "goals", "goalsAllowed")
    lost = F.col("gameId") % 3 == 0
    gaps = games.withColumns({c: F.when(lost, 0).otherwise(F.col(c)) for c in ("goals", "goalsAllowed")})
    sums = games.select("gameId", "playerTeam", F.when(F.col("gameId") % 2 == 0, F.col("goals")).alias("total"))
    return reports.repair_scores(gaps, sums, "goals", "goalsAllowed")


@query(
    "latest_results",
    f"""
    WITH {PLAYER_SQL}, l AS (SELECT MAX("gameDate") AS day FROM tg WHERE "gameDate" BETWEEN DATE '{TODAY}' - INTERVAL 14 DAY AND DATE '{TODAY}' - INTERVAL 1 DAY)
    SELECT "playerId", "playerTeam", shots FROM (SELECT pg.* FROM pg JOIN l ON "gameDate" = day WHERE "gameId" IS NOT NULL ORDER BY shots DESC, "playerId", "gameId" LIMIT 10) t""",
)
def results(spark, folder):
    games, players = team_games(spark, folder), player_games(spark, folder)
    _, best = reports.latest_results(games, players, TODAY, "shots", tie=("playerId", "gameId"))
    return best.select("playerId", "playerTeam", "shots")


@query(
    "latest_scores",
    f"""
    WITH {TEAM_SQL}, l AS (SELECT MAX("gameDate") AS day FROM tg WHERE "gameDate" BETWEEN DATE '{TODAY}' - INTERVAL 14 DAY AND DATE '{TODAY}' - INTERVAL 1 DAY)
    SELECT "gameId", "playerTeam", "opposingTeam", goals, "goalsAllowed" FROM tg JOIN l ON "gameDate" = day WHERE home_or_away = 'HOME'""",
)
def scores(spark, folder):
    games, players = team_games(spark, folder), player_games(spark, folder)
    latest, _ = reports.latest_results(games, players, TODAY, "shots")
    return latest.select("gameId", "playerTeam", "opposingTeam", "goals", "goalsAllowed")


@query(
    "upcoming_games",
    f"""
    WITH RECURSIVE {GAMES_SQL},
    w AS (SELECT * FROM pairs WHERE status = 'O' AND d > DATE '{TODAY}'), n AS (SELECT MIN(d) AS gd FROM w),
    s AS (SELECT DISTINCT p.d, p.home, p.away FROM pairs p JOIN n ON p.d = n.gd
      WHERE EXISTS (SELECT 1 FROM pairs q WHERE q.status = 'O' AND LEAST(q.home, q.away) = LEAST(p.home, p.away) AND GREATEST(q.home, q.away) = GREATEST(p.home, p.away))),
    {slate_sql("s", "d, home, away")}
    SELECT CAST(o.d AS VARCHAR) AS game_date, o.home, o.away FROM ordered o JOIN slate ON o.rn = slate.rn WHERE taken""",
)
def upcoming(spark, folder):
    pairs = nation_pairs(spark, folder)
    schedule = pairs.select(
        F.col("d").alias("DATE"), F.col("home").alias("HOME"), F.col("away").alias("AWAY"), F.lit("7:00 PM").alias("EASTERN")
    )
    waiting = pairs.filter("status = 'O'").select(
        F.lit(None).cast("long").alias("gameId"),
        F.col("game").alias("playerId"),
        F.col("d").alias("gameDate"),
        F.col("home").alias("playerTeam"),
        F.col("away").alias("opposingTeam"),
    )
    games = reports.upcoming_games(schedule, waiting, TODAY, "tomorrow")
    return games.select(text("game_date"), "home", "away")


@query(
    "predictions_view",
    f"""
    WITH {PREDICTION_SQL}, {_RANKS},
    c AS (SELECT *, COUNT(*) OVER (PARTITION BY "playerTeam", "gameDate") AS team_skater_count FROM pr WHERE "gameId" IS NULL AND LOWER("shooterName") LIKE '%ring%')
    SELECT c."order", c."playerId", team_skater_count, a.avg_made_pct AS team_rank, b.avg_allowed_pct AS opponent_rank FROM c LEFT JOIN ranks a ON c."playerTeam" = a."playerTeam"
      LEFT JOIN ranks b ON c."opposingTeam" = b."playerTeam" ORDER BY "gameDate", "predictedSOG" DESC, c."playerId", c."order" LIMIT 100""",
)
def view(spark, folder):
    ranks = rank_map(spark, folder).select(
        F.col("playerTeam").alias("team"), F.col("avg_made_pct").alias("made_pct"), F.col("avg_allowed_pct").alias("allowed_pct")
    )
    chosen = reports.prediction_filter(player="RING")
    shown = reports.predictions_view(predictions(spark, folder), None, chosen, ranks, limit=100, tie=("playerId", "order"))
    return shown.select("order", "playerId", "team_skater_count", "team_rank", "opponent_rank")


@query(
    "predictions_of_game",
    f"""
    WITH {PREDICTION_SQL} SELECT "order", "playerId", "predictedSOG" FROM pr WHERE "gameId" IS NULL AND LEAST("playerTeam", "opposingTeam") = 3 AND GREATEST("playerTeam", "opposingTeam") = 7
    ORDER BY "gameDate", "predictedSOG" DESC, "playerId", "order" LIMIT 100""",
)
def of_game(spark, folder):
    shown = reports.predictions_of_game(predictions(spark, folder), None, 7, 3, limit=100, tie=("playerId", "order"))
    return shown.select("order", "playerId", "predictedSOG")


@query(
    "game_analysis",
    f"""
    WITH {TEAM_SQL},
    n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerTeam" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM tg WHERE "gameDate" < DATE '{TODAY}'),
    l AS (SELECT *, CASE WHEN goals > "goalsAllowed" THEN 'W' ELSE 'L' END AS wl FROM n WHERE rn <= 10),
    f AS (SELECT "playerTeam", MAX(CASE WHEN rn = 1 THEN wl END) AS first FROM l GROUP BY 1),
    k AS (SELECT l."playerTeam", f.first, COALESCE(MIN(CASE WHEN wl <> f.first THEN rn END) - 1, COUNT(*)) AS len FROM l JOIN f ON l."playerTeam" = f."playerTeam" GROUP BY 1, 2)
    SELECT k."playerTeam", first || len AS streak,
      {r2('AVG(CASE WHEN goals > 0 OR "goalsAllowed" > 0 THEN goals END)', 1)} AS avg_scored, {r2('AVG(CASE WHEN goals > 0 OR "goalsAllowed" > 0 THEN "goalsAllowed" END)', 1)} AS avg_allowed,
      {r2("AVG(CASE WHEN shots > 0 THEN shots END)", 1)} AS avg_made, {r2('AVG(CASE WHEN "shotsAllowed" > 0 THEN "shotsAllowed" END)', 1)} AS avg_given
    FROM l JOIN k ON l."playerTeam" = k."playerTeam" WHERE rn <= 7 GROUP BY k."playerTeam", first, len""",
)
def analysis(spark, folder):
    return reports.game_analysis(team_games(spark, folder), TODAY, "goals", "goalsAllowed", "shots", "shotsAllowed")


@query(
    "player_detail",
    f"""
    WITH {PLAYER_SQL},
    h AS (SELECT * FROM pg WHERE "gameId" IS NOT NULL),
    m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerId", "opposingTeam" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM h),
    p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerId" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM h)
    SELECT u."order", u."playerId", COALESCE(m.shots, p.shots) AS shots FROM pg u LEFT JOIN m ON u."playerId" = m."playerId" AND u."opposingTeam" = m."opposingTeam" AND m.rn = 1
      LEFT JOIN p ON u."playerId" = p."playerId" AND p.rn = 1 WHERE u."gameId" IS NULL""",
)
def detail(spark, folder):
    rows = player_games(spark, folder)
    blank = rows.filter("gameId is null").withColumn("shots", F.lit(None).cast("long"))
    filled = reports.player_detail(blank, rows, F.lit(True), ["shots"])
    return filled.select("order", "playerId", "shots")


_CHART = [("avg_last7", "Avg (7g)"), ("avg_last3", "Avg (3g)"), ("last_value", "Last Game"), ("predictedSOG", "Predicted")]


@query(
    "chart_points",
    f"WITH {PREDICTION_SQL} "
    + " UNION ALL ".join(
        f"""SELECT "order", "playerId", '{label}' AS label, CAST("{c}" AS DOUBLE) AS value FROM pr WHERE "gameId" IS NULL""" for c, label in _CHART
    ),
)
def chart(spark, folder):
    return reports.chart_points(predictions(spark, folder).filter("gameId is null"), ["order", "playerId"])


def _last(n):
    inside = f"rn <= {n}"
    return f"""CAST(SUM(CASE WHEN {inside} AND shots >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS shots_3plus_last_{n}, CAST(SUM(CASE WHEN {inside} THEN goals ELSE 0 END) AS BIGINT) AS total_goals_last_{n},
      CAST(SUM(CASE WHEN {inside} THEN 1 ELSE 0 END) AS BIGINT) AS n_last_{n}"""


@query(
    "recent_trends",
    f"""
    WITH {PLAYER_SQL},
    n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerId" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM pg WHERE "gameId" IS NOT NULL),
    l AS (SELECT * FROM n WHERE rn <= 20)
    SELECT "playerId", {_last(5)}, {_last(20)}, CAST(COALESCE(MIN(CASE WHEN goals < 1 THEN rn END) - 1, COUNT(*)) AS BIGINT) AS streak_goals_1plus FROM l GROUP BY 1""",
)
def trends(spark, folder):
    found = reports.recent_trends(player_games(spark, folder), ["playerId"], "gameDate", "gameId", "shots", "goals", "assists")
    kinds = [f"{k}_last_{n}" for n in (5, 20) for k in ("shots_3plus", "total_goals", "n")]
    return found.select("playerId", *kinds, "streak_goals_1plus")


_SENTENCES = [
    f"CASE WHEN n10 >= 5 AND {column} > 0 THEN '{label}: ' || {column} || ' {word} past ' || n10 END"
    for column, label, word in (("g10", "goals", "over the"), ("a10", "assists", "over the"), ("s3", "three shots or more", "of the"), ("s2", "two shots or more", "of the"))
] + [
    f"CASE WHEN {column} >= 2 THEN '{label}, running: ' || {column} END"
    for column, label in (("k3", "three shots or more"), ("k2", "two shots or more"), ("ka", "an assist"), ("kg", "a goal"), ("kp", "a point"))
]


def _run(condition):
    return f"COALESCE(MIN(CASE WHEN NOT ({condition}) THEN rn END) - 1, COUNT(*))"


@query(
    "trend_sentences",
    f"""
    WITH {PLAYER_SQL},
    n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerId" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM pg WHERE "gameId" IS NOT NULL),
    t AS (SELECT "playerId", SUM(CASE WHEN rn <= 10 THEN 1 ELSE 0 END) AS n10, SUM(CASE WHEN rn <= 10 THEN goals ELSE 0 END) AS g10, SUM(CASE WHEN rn <= 10 THEN assists ELSE 0 END) AS a10,
      SUM(CASE WHEN rn <= 10 AND shots >= 3 THEN 1 ELSE 0 END) AS s3, SUM(CASE WHEN rn <= 10 AND shots >= 2 THEN 1 ELSE 0 END) AS s2,
      {_run("shots >= 3")} AS k3, {_run("shots >= 2")} AS k2, {_run("assists >= 1")} AS ka, {_run("goals >= 1")} AS kg, {_run("goals + assists >= 1")} AS kp
      FROM n WHERE rn <= 20 GROUP BY "playerId")
    SELECT "playerId", array_to_string(list_filter([{", ".join(_SENTENCES)}], lambda x: x IS NOT NULL), '; ') AS sentences FROM t""",
)
def sentences(spark, folder):
    found = reports.recent_trends(player_games(spark, folder), ["playerId"], "gameDate", "gameId", "shots", "goals", "assists")
    lines = reports.trend_sentences(found, ["playerId"])
    return lines.select("playerId", F.array_join("sentences", "; ").alias("sentences"))


@query(
    "hit_rate_history",
    f"""WITH {PREDICTION_SQL} SELECT CAST("gameDate" AS VARCHAR) AS d, "gameId", hit_rate_2plus FROM pr WHERE "shooterName" = (SELECT MIN(p_name) FROM part) AND "gameId" IS NOT NULL ORDER BY "gameDate", "gameId", "playerId" LIMIT 100""",
)
def history(spark, folder):
    rows = predictions(spark, folder)
    first = table(spark, folder, "part").agg(F.min("p_name")).scalar()
    found = reports.hit_rate_history(rows, first, ["hit_rate_2plus"], limit=100, tie=("playerId",))
    return found.select(F.col("gameDate").cast("string").alias("d"), "gameId", "hit_rate_2plus")


@query(
    "player_stats_list",
    f"""WITH {PLAYER_SQL} SELECT "gameId", "playerId", shots FROM pg WHERE "gameId" IS NOT NULL AND "playerTeam" = 4 ORDER BY "gameDate" DESC, "gameId" DESC, "playerId" LIMIT 100""",
)
def stats_list(spark, folder):
    rows = reports.player_stats_list(player_games(spark, folder), F.col("playerTeam") == 4, limit=100)
    return rows.select("gameId", "playerId", "shots")


@query(
    "latest_ranks",
    f"""
    WITH {TEAM_SQL}, l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "opposingTeam" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM tg)
    SELECT "opposingTeam", CAST("gameDate" AS VARCHAR) AS d, shots, goals FROM l WHERE rn = 1""",
)
def newest_ranks(spark, folder):
    found = reports.latest_ranks(team_games(spark, folder), "opposingTeam", "gameDate", "gameId", ["shots", "goals"])
    return found.select("opposingTeam", F.col("gameDate").cast("string").alias("d"), "shots", "goals")


@query(
    "historical_games",
    f"""
    WITH {TEAM_SQL},
    n AS (SELECT * REPLACE (CASE WHEN "gameId" % 5 > 0 OR home_or_away = 'AWAY' THEN goals END AS goals) FROM tg),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "gameId" ORDER BY CASE WHEN home_or_away = 'HOME' THEN 0 ELSE 1 END) AS rn FROM n
      WHERE "gameDate" < DATE '{TODAY}'),
    v AS (SELECT "gameId" AS game_id, CAST("gameDate" AS VARCHAR) AS game_date, CASE WHEN home_or_away = 'HOME' THEN "playerTeam" ELSE "opposingTeam" END AS home, CASE WHEN home_or_away = 'HOME' THEN "opposingTeam" ELSE "playerTeam" END AS away,
      CASE WHEN home_or_away = 'HOME' THEN goals ELSE "goalsAllowed" END AS goals_for, CASE WHEN home_or_away = 'HOME' THEN "goalsAllowed" ELSE goals END AS goals_against FROM k WHERE rn = 1)
    SELECT *, CASE WHEN goals_for > goals_against THEN 'Yes' ELSE 'No' END AS is_win FROM v ORDER BY game_date DESC, game_id DESC LIMIT 100""",
)
def past_games(spark, folder):
    """The home side's goals of every fifth game aren't known."""
    known = (F.col("gameId") % 5 > 0) | (F.col("home_or_away") == "AWAY")
    rows = team_games(spark, folder).withColumn("goals", F.when(known, F.col("goals")))
    return reports.historical_games(rows, "goals", "goalsAllowed", before=TODAY, limit=100)


@query(
    "game_box",
    f"""
    WITH {PLAYER_SQL}, firsts AS (SELECT d, home, away FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY d ORDER BY game) AS rn FROM pairs) f WHERE rn = 1),
    u AS (
      SELECT 'player' AS kind, "gameId", "gameDate", "playerTeam", "opposingTeam", "playerId", shots, goals, NULL AS allowed FROM pg
      UNION ALL SELECT 'team', "gameId", "gameDate", "playerTeam", "opposingTeam", NULL, shots, goals, "goalsAllowed" FROM tg)
    SELECT kind, "gameId", "playerTeam", "playerId", shots, goals, allowed FROM u JOIN firsts
    ON "gameDate" = d AND LEAST(home, away) = LEAST("playerTeam", "opposingTeam") AND GREATEST(home, away) = GREATEST("playerTeam", "opposingTeam")""",
)
def box(spark, folder):
    """Players and teams of the first game of every day."""
    firsts = nation_pairs(spark, folder).groupBy("d").agg(F.min_by(F.struct("home", "away"), "game").alias("g")).select(F.col("d").alias("date"), "g.home", "g.away")
    values = {"shots": "shots", "goals": "goals", "allowed": "goalsAllowed"}
    return reports.game_boxes(player_games(spark, folder), team_games(spark, folder), firsts, values)


@query(
    "last_finished_game",
    f"""
    WITH {TEAM_SQL}, l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "playerTeam" ORDER BY "gameDate" DESC, "gameId" DESC) AS rn FROM tg WHERE "gameDate" < DATE '{TODAY}')
    SELECT "playerTeam", "opposingTeam", "gameId", goals FROM l WHERE rn = 1""",
)
def last_finished(spark, folder):
    found = reports.last_finished_game(team_games(spark, folder), TODAY)
    return found.select("playerTeam", "opposingTeam", "gameId", "goals")


@query(
    "bi_summary",
    f"""
    WITH {PREDICTION_SQL}, l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "shooterName", "gameDate", "playerTeam", "opposingTeam" ORDER BY abs_gap DESC, "predictedSOG" DESC, "playerId") AS rn FROM pr)
    SELECT "shooterName", CAST("gameDate" AS VARCHAR) AS d, "playerTeam", "opposingTeam", "playerId", abs_gap FROM l WHERE rn = 1""",
)
def summary(spark, folder):
    found = reports.bi_summary(predictions(spark, folder))
    return found.select("shooterName", F.col("gameDate").cast("string").alias("d"), "playerTeam", "opposingTeam", "playerId", "abs_gap")


def _picks(spark, folder):
    """Every player row of a played game is picked, the type by its part; a third
    of the picks know only the name. Actuals of odd games have lost id and name."""
    rows = player_games(spark, folder).filter("gameId is not null")
    known = F.col("gameId") % 2 == 0
    kinds = ["sog", "sog_2", "sog_3", "sog_4", "goal", "point", "assist", "other"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("playerId") % 8 + 1).cast("int"))
    picks = rows.select(
        F.col("gameId").alias("id"),
        F.col("gameDate").alias("game_date"),
        F.col("playerTeam").alias("player_team"),
        F.col("opposingTeam").alias("opposing_team"),
        F.when(F.col("playerId") % 3 != 0, F.col("playerId").cast("string")).alias("player_id"),
        F.concat(F.lit(" P"), F.col("playerId"), F.lit("-"), F.col("gameId")).alias("player_name"),
        kind.alias("pick_type"),
        (F.col("shots") * 0.9).alias("predicted_sog"),
    )
    actuals = rows.select(
        F.col("gameDate").alias("game_date"),
        F.col("playerTeam").alias("player_team"),
        F.col("opposingTeam").alias("opposing_team"),
        F.when(known, F.col("playerId").cast("string")).alias("player_id"),
        F.when(known, F.concat(F.lit("P"), F.col("playerId"), F.lit("-"), F.col("gameId"))).alias("player_name"),
        F.col("shots").alias("actual_sog"),
        F.col("goals").alias("actual_goal"),
        F.col("assists").alias("actual_assist"),
    )
    return picks, actuals


_GRADED = f"""{PLAYER_SQL},
rows AS (SELECT * FROM pg WHERE "gameId" IS NOT NULL),
act AS (SELECT "gameId", "gameDate", "playerTeam", "opposingTeam", CASE WHEN "gameId" % 2 = 0 THEN "playerId" END AS "playerId", shots, goals, assists FROM rows),
byid AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "gameDate", "playerTeam", "opposingTeam", "playerId" ORDER BY shots DESC, goals DESC, assists DESC) AS rn FROM act) t WHERE rn = 1),
graded AS (SELECT r."gameId" AS id, r."playerId" AS p, r.shots * 0.9 AS pred, r."playerId" % 8 AS k,
  CASE WHEN i."playerId" IS NOT NULL THEN 1 WHEN n."playerId" IS NOT NULL THEN 2 END AS tier, COALESCE(i.shots, n.shots) AS s, COALESCE(i.goals, n.goals) AS g, COALESCE(i.assists, n.assists) AS a
  FROM rows r LEFT JOIN byid i ON r."gameDate" = i."gameDate" AND r."playerTeam" = i."playerTeam" AND r."opposingTeam" = i."opposingTeam" AND r."playerId" = i."playerId" AND r."playerId" % 3 <> 0
  LEFT JOIN act n ON r."gameId" = n."gameId" AND r."playerId" = n."playerId"),
hits AS (SELECT *, CASE WHEN tier IS NULL THEN NULL ELSE CASE k WHEN 0 THEN ABS(s - pred) <= 1 WHEN 1 THEN s >= 2 WHEN 2 THEN s >= 3 WHEN 3 THEN s >= 4 WHEN 4 THEN g >= 1 WHEN 5 THEN g + a >= 1 WHEN 6 THEN a >= 1 END END AS hit FROM graded)"""


@query(
    "pick_grading",
    f"""WITH {_GRADED} SELECT id, ' P' || p || '-' || id AS player_name_raw, s AS actual_sog, CAST(hit AS INTEGER) AS hit, tier AS matched_by FROM hits""",
)
def grading(spark, folder):
    picks, actuals = _picks(spark, folder)
    graded = reports.grade_picks(picks, actuals)
    return graded.select(
        "id",
        F.concat(F.lit(" "), F.col("player_name")).alias("player_name_raw"),
        "actual_sog",
        F.col("hit").cast("int").alias("hit"),
        "matched_by",
    )


@query(
    "pick_accuracy",
    f"""
    WITH {_GRADED} SELECT CASE k WHEN 0 THEN 'sog' WHEN 1 THEN 'sog_2' WHEN 2 THEN 'sog_3' WHEN 3 THEN 'sog_4' WHEN 4 THEN 'goal' WHEN 5 THEN 'point' ELSE 'assist' END AS pick_type,
      COUNT(*) AS n_picks, CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS n_hits, {r2("100.0 * SUM(CASE WHEN hit THEN 1 ELSE 0 END) / COUNT(*)", 1)} AS accuracy
    FROM hits WHERE hit IS NOT NULL GROUP BY 1""",
)
def accuracy(spark, folder):
    return reports.pick_accuracy(reports.grade_picks(*_picks(spark, folder)), ["pick_type"])


@query(
    "picks_nearest_schedule",
    f"""
    WITH {GAMES_SQL},
    p AS (SELECT game AS id, home, away, CAST(d + INTERVAL 3 DAY AS DATE) AS gd FROM pairs WHERE status <> 'O'),
    s AS (SELECT DISTINCT home, away, d AS sd FROM pairs WHERE status = 'O'),
    m AS (SELECT p.id, p.gd, s.sd, ROW_NUMBER() OVER (PARTITION BY p.id ORDER BY ABS(date_diff('day', p.gd, s.sd)), s.sd) AS rn FROM p LEFT JOIN s ON p.home = s.home AND p.away = s.away)
    SELECT id, CAST(COALESCE(sd, gd) AS VARCHAR) AS display_game_date, CASE WHEN sd IS NOT NULL THEN '7:00 PM' END AS display_game_time FROM m WHERE rn = 1""",
)
def picks_schedule(spark, folder):
    pairs = nation_pairs(spark, folder)
    codes = [F.col("home").cast("string"), F.col("away").cast("string")]
    picks = pairs.filter("status <> 'O'").select(
        F.col("game").alias("id"),
        codes[0].alias("home_team"),
        codes[1].alias("away_team"),
        F.date_add("d", 3).alias("game_date"),
    )
    schedule = pairs.filter("status = 'O'").select(
        codes[0].alias("HOME"), codes[1].alias("AWAY"), F.col("d").alias("DATE"), F.lit("7:00 PM").alias("EASTERN")
    )
    matched = reports.picks_with_schedule(picks, schedule)
    return matched.select("id", text("display_game_date"), "display_game_time")


_EVENT_LAST = "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)"


@query(
    "current_streak",
    f"""
    WITH n AS (SELECT *, {_EVENT_LAST} AS rn FROM events)
    SELECT user_id, CAST(COALESCE(MIN(CASE WHEN value < 5 THEN rn END) - 1, COUNT(*)) AS BIGINT) AS above_5,
      CAST(COALESCE(MIN(CASE WHEN event_type = 'error' THEN rn END) - 1, COUNT(*)) AS BIGINT) AS no_error FROM n GROUP BY user_id""",
)
def streak(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "event_type")
    conditions = {"above_5": F.col("value") >= 5, "no_error": F.col("event_type") != "error"}
    return current_streak(events, ["user_id"], ["ts", "event_id"], conditions)


@query(
    "hit_rates_last_n",
    f"""
    WITH n AS (SELECT *, {_EVENT_LAST} AS rn FROM events)
    SELECT user_id, """
    + ", ".join(
        f"CAST(SUM(CASE WHEN rn <= {n} AND value >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS value_20plus_last_{n}, CAST(SUM(CASE WHEN rn <= {n} AND value >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS value_60plus_last_{n}, CAST(SUM(CASE WHEN rn <= {n} THEN 1 ELSE 0 END) AS BIGINT) AS n_last_{n}"
        for n in (5, 10, 15, 20)
    )
    + " FROM n GROUP BY user_id",
)
def last_n(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    hits = {"value_20plus": F.col("value") >= 20, "value_60plus": F.col("value") >= 60}
    return hit_rates_last_n(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], hits)
