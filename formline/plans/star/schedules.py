"""Schedules, rosters, fills and dates over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators.lastknown import first_known_per_key, last_known_fill
from formline.operators.joins import null_safe_join
from formline.operators.matching import with_scalar
from formline.operators.schedule import (
    best_available_date,
    combine_schedules,
    drop_before_season_start,
    expand_schedule,
    first_games_of_slate,
    first_open_game,
    join_schedule,
    keep_listed,
    latest_date_plus,
    next_date_after,
    next_game_per_member,
    next_upcoming_only,
    null_id_after,
    recent_as_upcoming,
    roster_fill,
    roster_projection,
    schedule_from_facts,
    split_played,
    with_day_and_times,
)
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_games, nation_pairs, query, slate_sql, table, text

CUTOFF = "2001-01-01"


@query(
    "schedule_expand",
    f"""WITH {GAMES_SQL} SELECT game, CAST(d AS VARCHAR) AS d, team, opponent, side FROM games""",
)
def schedule_expand(spark, folder):
    pairs = nation_pairs(spark, folder)
    return expand_schedule(pairs, "home", "away", "team", "opponent", "side").select(
        "game", text("d"), "team", "opponent", "side"
    )


@query(
    "schedule_from_facts",
    f"""
    WITH {GAMES_SQL} SELECT game, CAST(d AS VARCHAR) AS d, MAX(CASE WHEN side = 'HOME' THEN team END) AS "HOME",
      MAX(CASE WHEN side = 'AWAY' THEN team END) AS "AWAY" FROM games GROUP BY game, d""",
)
def schedule_facts(spark, folder):
    games = nation_games(spark, folder)
    return schedule_from_facts(games, ["game", "d"], "side", "team").withColumn("d", F.col("d").cast("string"))


@query(
    "schedule_outer_join",
    f"""
    WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '{CUTOFF}' AND o_orderpriority <> '5-LOW' THEN o_orderkey END AS game FROM orders),
    f AS (SELECT l_orderkey AS game, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey)
    SELECT s.o_orderkey, CAST(s.d AS VARCHAR) AS d, COALESCE(s.game, f.game) AS game, f.qty FROM s FULL OUTER JOIN f ON s.game = f.game""",
)
def schedule_outer_join(spark, folder):
    """Orders of low priority have no id to meet their lines by."""
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate", "o_orderpriority")
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("game")
    planned = orders.select("o_orderkey", F.col("o_orderdate").alias("d"), known)
    planned = null_id_after(planned, "game", "d", CUTOFF)
    facts = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("game")).agg(
        F.sum("l_quantity").alias("qty")
    )
    return join_schedule(planned, facts, ["game"]).withColumn("d", F.col("d").cast("string"))


@query(
    "schedule_left_join",
    """
    SELECT o_orderkey, l_linenumber, l_partkey, l_quantity FROM orders LEFT JOIN (
      SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) t WHERE rn = 1) l
    ON o_orderkey = l_orderkey""",
)
def schedule_left_join(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return join_schedule(orders, lines, ["o_orderkey"], "left", order).drop("l_suppkey")


@query(
    "combine_schedules",
    f"""
    SELECT o_orderkey, o_orderstatus, 'played' AS origin FROM orders WHERE o_orderdate <= DATE '{CUTOFF}'
    UNION ALL SELECT o_orderkey, o_orderstatus, 'planned' FROM orders WHERE o_orderdate > DATE '{CUTOFF}'""",
)
def combined(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate", "o_orderstatus")
    played, _ = split_played(orders, "o_orderdate", CUTOFF)
    both = combine_schedules(
        played.withColumn("origin", F.lit("played")), orders.withColumn("origin", F.lit("planned")), ["o_orderkey"], ["o_orderdate"]
    )
    return both.drop("o_orderdate")


_OPEN = "SELECT o_orderkey, c_nationkey AS team, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'"


@query(
    "roster_fill_next_only",
    f"""
    WITH nxt AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY team ORDER BY d, o_orderkey) AS rn FROM ({_OPEN}) o)
    SELECT c_custkey, c_nationkey AS team, o_orderkey, CAST(d AS VARCHAR) AS d FROM customer JOIN nxt ON c_nationkey = team AND rn = 1""",
)
def roster_next(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("team"))
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus").filter("o_orderstatus = 'O'")
    games = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "team", F.col("o_orderdate").alias("d")
    )
    filled = next_game_per_member(games, customer, ["team"], ["c_custkey"], ["d", "o_orderkey"])
    return filled.select("c_custkey", "team", "o_orderkey", text("d"))


@query(
    "roster_fill",
    """
    WITH s AS (SELECT l_orderkey, l_suppkey FROM lineitem)
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey END AS game, CASE WHEN o_orderstatus = 'O' THEN l_suppkey ELSE o_custkey END AS player
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l ON o_orderkey = l_orderkey AND o_orderstatus = 'O'""",
)
def roster_members(spark, folder):
    """Open orders have no player yet: each gets the suppliers on its lines."""
    waiting = F.col("o_orderstatus") == "O"
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(~waiting, F.col("o_orderkey")).alias("game"),
        F.when(~waiting, F.col("o_custkey")).alias("player"),
    )
    roster = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("player"))
    return roster_fill(orders, roster, ["o_orderkey"], ["player"], "game", "player")


@query(
    "next_upcoming_only",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O') t WHERE rn = 1""",
)
def next_only(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    kept = next_upcoming_only(orders, ["o_custkey"], F.col("o_orderstatus") == "O", ["o_orderdate", "o_orderkey"])
    return kept.drop("o_orderdate")


@query(
    "roster_projection",
    """
    WITH r AS (SELECT DISTINCT o_custkey, CAST(YEAR(o_orderdate) AS INTEGER) AS season FROM orders)
    SELECT o_custkey, season FROM r UNION SELECT o_custkey, 2001 FROM r WHERE season = 2000""",
)
def projected_roster(spark, folder):
    orders = dated_orders(spark, folder, "o_custkey", "o_orderdate")
    roster = orders.select("o_custkey", F.year("o_orderdate").alias("season")).distinct()
    return roster_projection(roster, "season", 2000, 2001)


@query(
    "null_safe_merge",
    """
    WITH g AS (SELECT CASE WHEN o_orderstatus = 'O' THEN NULL ELSE YEAR(o_orderdate) END AS k, o_orderkey, o_custkey FROM orders),
    m AS (SELECT k, COUNT(*) AS n, MAX(o_custkey) AS top FROM g GROUP BY k)
    SELECT g.o_orderkey, m.n, m.top FROM g LEFT JOIN m ON g.k IS NOT DISTINCT FROM m.k""",
)
def null_safe_merge(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    games = orders.select(
        F.when(F.col("o_orderstatus") != "O", F.year("o_orderdate")).alias("k"), "o_orderkey", "o_custkey"
    )
    totals = games.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("o_custkey").alias("top"))
    return null_safe_join(games, totals, ["k"], "left").select("o_orderkey", "n", "top")


@query(
    "last_known_fill",
    f"""
    WITH {GAMES_SQL},
    h AS (SELECT * FROM games WHERE status <> 'O'),
    m AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team, opponent ORDER BY d DESC, game DESC) AS rn FROM h) t WHERE rn = 1),
    t AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team ORDER BY d DESC, game DESC) AS rn FROM h) t WHERE rn = 1),
    o AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY opponent ORDER BY d DESC, game DESC) AS rn FROM h) t WHERE rn = 1)
    SELECT u.game, u.team, COALESCE(m.pointsFor, t.pointsFor) AS "pointsFor", COALESCE(m.pointsAgainst, o.pointsAgainst) AS "pointsAgainst"
    FROM (SELECT * FROM games WHERE status = 'O') u LEFT JOIN m ON u.team = m.team AND u.opponent = m.opponent
    LEFT JOIN t ON u.team = t.team LEFT JOIN o ON u.opponent = o.opponent""",
)
def last_known(spark, folder):
    games = nation_games(spark, folder)
    waiting = games.filter("status = 'O'").select("game", "team", "opponent", F.lit(None).cast("long").alias("pointsFor"))
    history = games.filter("status <> 'O'")
    filled = last_known_fill(
        waiting,
        history,
        [
            (["team", "opponent"], ["pointsFor", "pointsAgainst"]),
            (["team"], ["pointsFor"]),
            (["opponent"], ["pointsAgainst"]),
        ],
        ["d", "game"],
    )
    return filled.select("game", "team", "pointsFor", "pointsAgainst")


@query(
    "allow_list",
    f"""
    WITH {GAMES_SQL}
    SELECT game, team, opponent FROM games WHERE team IN (1, 2, 3, 5, 8, 13, 21) AND opponent IN (1, 2, 3, 5, 8, 13, 21)
      AND (status = 'O' OR d >= CASE YEAR(d) WHEN 1999 THEN DATE '1999-03-01' WHEN 2000 THEN DATE '2000-02-01' ELSE DATE '1900-01-01' END)""",
)
def allow_list(spark, folder):
    games = nation_games(spark, folder).withColumn("season", F.year("d"))
    kept = keep_listed(games, ["team", "opponent"], [1, 2, 3, 5, 8, 13, 21])
    started = drop_before_season_start(
        kept, "season", "d", {1999: "1999-03-01", 2000: "2000-02-01"}, F.col("status") == "O"
    )
    return started.select("game", "team", "opponent")


@query(
    "scalar_cross_join",
    """
    SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), m.last_day) AS days_before FROM orders CROSS JOIN (SELECT MAX(CAST(o_orderdate AS DATE)) AS last_day FROM orders) m""",
)
def scalar_cross(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate")
    joined = with_scalar(orders, orders.agg(F.max("o_orderdate").alias("last_day")))
    return joined.select("o_orderkey", F.datediff("last_day", "o_orderdate").cast("long").alias("days_before"))


@query(
    "best_available_date",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE CAST(o_orderdate AS DATE) =
      (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-08-05' - INTERVAL 7 DAY AND DATE '2001-08-05')""",
)
def best_date(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return best_available_date(orders, "o_orderdate", "2001-08-05", 7).select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("d")
    )


@query(
    "next_date_after",
    """
    SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) =
      (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) > DATE '1999-12-24')""",
)
def next_date(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return next_date_after(orders, "o_orderdate", "1999-12-24", F.col("o_orderstatus") == "O").select("o_orderkey")


@query(
    "first_open_game",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O') t WHERE rn = 1""",
)
def first_open(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    value = F.when(F.col("o_orderstatus") != "O", 1)
    first = first_open_game(orders, ["o_custkey", "o_orderpriority"], value, ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "latest_date_plus",
    """SELECT o_custkey, CAST(CAST(MAX(CAST(o_orderdate AS DATE)) + INTERVAL 2 DAY AS DATE) AS VARCHAR) AS next_date FROM orders GROUP BY o_custkey""",
)
def date_plus(spark, folder):
    orders = dated_orders(spark, folder, "o_custkey", "o_orderdate")
    return latest_date_plus(orders, ["o_custkey"], "o_orderdate").withColumn("next_date", F.col("next_date").cast("string"))


@query(
    "slate_first_games",
    f"""
    WITH RECURSIVE {GAMES_SQL}, {slate_sql("pairs", "d, game, home, away")}
    SELECT o.game, o.home, o.away FROM ordered o JOIN slate ON o.rn = slate.rn WHERE taken""",
)
def slate(spark, folder):
    pairs = nation_pairs(spark, folder)
    return first_games_of_slate(pairs, "home", "away", ["d", "game"]).select("game", "home", "away")


@query(
    "recent_as_upcoming",
    """
    SELECT CAST(NULL AS BIGINT) AS o_orderkey, o_custkey FROM (SELECT * FROM orders WHERE o_orderdate <= DATE '2002-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 35) t""",
)
def recent_stand_in(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate")
    later = F.col("o_orderdate") > F.lit("2002-01-01").cast("date")
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return recent_as_upcoming(orders, "o_orderkey", newest, later).select("o_orderkey", "o_custkey")


@query(
    "first_known_per_key",
    """
    WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS p, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS u FROM orders)
    SELECT o_custkey, arg_min(p, (o_orderdate, o_orderkey)) FILTER (p IS NOT NULL) AS p, arg_min(u, (o_orderdate, o_orderkey)) FILTER (u IS NOT NULL) AS u FROM o GROUP BY 1""",
)
def first_known(spark, folder):
    orders = dated_orders(
        spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    rows = orders.select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("p"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")).alias("u"),
    )
    return first_known_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["p", "u"])


@query(
    "default_start_times",
    """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%a') AS "DAY", CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '7:00 PM Default' END AS "EASTERN",
      '7:00 PM Default' AS "LOCAL" FROM orders""",
)
def default_start_times(spark, folder):
    """The priority stands for a start time, unknown where it is low; there is no local time."""
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate", "o_orderpriority")
    known = orders.withColumn("EASTERN", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return with_day_and_times(known, "o_orderdate").select("o_orderkey", "DAY", "EASTERN", "LOCAL")
