"""Rolling form over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions.numbers import ratio, round_half_up
from formline.operators.ordered import Running, over_ordered
from formline.operators.ranking import is_latest
from formline.operators.rolling import (
    games_played,
    group_median,
    hit_rate_last_days,
    keep_rank_nulls,
    own_opponent_form,
    playoff_flag,
    previous_row,
    rolling_form,
    running_totals,
    season_hit_rate,
    team_form,
)
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_games, query, r2, row_bound, table

KNOWN_PRICE = "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END"
BY_CUSTOMER = "PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey"


def _priced(spark, folder, *more):
    """Orders whose price is unknown when urgent, so that gaps occur."""
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice", *more]
    return dated_orders(spark, folder, *columns).withColumn("price", F.expr(KNOWN_PRICE)).drop(
        "o_orderpriority", "o_totalprice"
    )


@query(
    "form_prev_last3_last7",
    f"""
    SELECT o_orderkey, o_custkey,
      {r2(f"LAST_VALUE(price IGNORE NULLS) OVER ({BY_CUSTOMER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")} AS previous_price,
      {r2(f"AVG(price) OVER ({BY_CUSTOMER} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS average_price_last_3_games,
      {r2(f"AVG(price) OVER ({BY_CUSTOMER} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS average_price_last_7_games,
      COUNT(o_orderkey) OVER ({BY_CUSTOMER} ROWS UNBOUNDED PRECEDING) AS orders_so_far,
      CASE WHEN LEAD(1) OVER ({BY_CUSTOMER}) IS NULL THEN 1 ELSE 0 END AS is_latest
    FROM (SELECT *, {KNOWN_PRICE} AS price FROM orders) t""",
)
def form_prev_last3_last7(spark, folder):
    orders = _priced(spark, folder)
    formed = rolling_form(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        ["price"],
        extra=[Running("orders_so_far", F.col("o_orderkey"), "count"), is_latest("is_latest")],
        bounded_by=row_bound(spark, folder, "orders"),
    )
    return formed.drop("o_orderdate", "price")


_PLAYED = "o_orderstatus <> 'O'"


def _by_status(n):
    return f"""CASE WHEN {_PLAYED} THEN AVG(o_totalprice) OVER ({BY_CUSTOMER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
       ELSE AVG(o_totalprice) OVER ({BY_CUSTOMER} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END"""


@query(
    "form_inclusive_vs_upcoming",
    f"""
    SELECT o_orderkey, o_orderstatus,
      COALESCE({r2(f"LAG(o_totalprice) OVER ({BY_CUSTOMER})")}, 0.0) AS "previous_o_totalprice",
      COALESCE({r2(_by_status(3))}, 0.0) AS "average_o_totalprice_last_3_games",
      COALESCE({r2(_by_status(7))}, 0.0) AS "average_o_totalprice_last_7_games"
    FROM orders""",
)
def form_inclusive_vs_upcoming(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    formed = rolling_form(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        ["o_totalprice"],
        played=F.expr(_PLAYED),
        include_current="played",
        zero_fill=keep_rank_nulls,
        bounded_by=[orders],
    )
    return formed.drop("o_custkey", "o_orderdate", "o_totalprice")


_MATCHUP = "PARTITION BY o_custkey, s_nationkey ORDER BY d, o_orderkey"


@query(
    "form_matchup",
    f"""
    WITH m AS (
      SELECT o_orderkey, o_custkey, s_nationkey, CAST(o_orderdate AS DATE) AS d, SUM(l_quantity) AS qty
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
      GROUP BY o_orderkey, o_custkey, s_nationkey, CAST(o_orderdate AS DATE))
    SELECT o_orderkey, o_custkey, s_nationkey,
      {r2(f"LAG(qty) OVER ({_MATCHUP})")} AS matchup_previous_qty,
      {r2(f"AVG(qty) OVER ({_MATCHUP} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS matchup_average_qty_last_3_games,
      {r2(f"AVG(qty) OVER ({_MATCHUP} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS matchup_average_qty_last_7_games,
      COUNT(*) OVER ({_MATCHUP} ROWS UNBOUNDED PRECEDING) AS matchups_so_far
    FROM m""",
)
def form_matchup(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate")
    sums = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey", "s_nationkey").agg(
        F.sum("l_quantity").alias("qty")
    )
    met = sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    formed = rolling_form(
        met,
        ["o_custkey", "s_nationkey"],
        ["o_orderdate", "o_orderkey"],
        ["qty"],
        prefix="matchup_",
        extra=[Running("matchups_so_far", F.col("o_orderkey"), "count")],
        bounded_by=[lines],
    )
    return formed.drop("qty", "o_orderdate", "l_orderkey")


def _trio(prefix, partition, counter):
    order = f"PARTITION BY {partition} ORDER BY d, game"
    median = f"MEDIAN(pointsFor) OVER (PARTITION BY {partition})"
    return f"""
      CASE WHEN {counter} > 1 THEN {r2(f"LAG(pointsFor) OVER ({order})")} ELSE {r2(median)} END AS "{prefix}previous_pointsFor",
      CASE WHEN {counter} > 3 THEN {r2(f"AVG(pointsFor) OVER ({order} ROWS 2 PRECEDING)")} ELSE {r2(median)} END AS "{prefix}average_pointsFor_last_3_games",
      CASE WHEN {counter} > 7 THEN {r2(f"AVG(pointsFor) OVER ({order} ROWS 6 PRECEDING)")} ELSE {r2(median)} END AS "{prefix}average_pointsFor_last_7_games" """


@query(
    "team_form_median_warmup",
    f"""
    WITH {GAMES_SQL},
    counted AS (
      SELECT *, COUNT(*) OVER (PARTITION BY team ORDER BY d, game ROWS UNBOUNDED PRECEDING) AS n_team,
        COUNT(*) OVER (PARTITION BY team, opponent ORDER BY d, game ROWS UNBOUNDED PRECEDING) AS n_matchup FROM games)
    SELECT game, team, opponent, n_team, n_matchup,
      {_trio("", "team", "n_team")}, {_trio("opponent_", "opponent", "n_team")}, {_trio("matchup_", "team, opponent", "n_matchup")}
    FROM counted""",
)
def team_form_median_warmup(spark, folder):
    games = nation_games(spark, folder).select("game", "d", "team", "opponent", "pointsFor")
    order, bound = ["d", "game"], row_bound(spark, folder, "orders", 2)
    counted = games_played(games, ["team"], order, "game", "n_team", bounded_by=bound)
    counted = games_played(counted, ["team", "opponent"], order, "game", "n_matchup", bounded_by=bound)
    formed = team_form(
        counted, "team", "opponent", order, ["pointsFor"], "n_team", "n_matchup", bounded_by=bound
    )
    return formed.drop("d", "pointsFor")


@query(
    "faced_opponent_form",
    f"""
    WITH {GAMES_SQL}
    SELECT game, team, opponent,
      {r2("LAG(pointsFor) OVER (PARTITION BY opponent ORDER BY d, game)")} AS "opponent_previous_pointsFor",
      {r2("AVG(pointsFor) OVER (PARTITION BY opponent ORDER BY d, game ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS "opponent_average_pointsFor_last_3_games"
    FROM games""",
)
def faced_opponent_form(spark, folder):
    games = nation_games(spark, folder).select("game", "d", "team", "opponent", "pointsFor")
    formed = rolling_form(
        games,
        ["opponent"],
        ["d", "game"],
        ["pointsFor"],
        windows=[3],
        prefix="opponent_",
        bounded_by=row_bound(spark, folder, "orders", 2),
    )
    return formed.drop("d", "pointsFor")


@query(
    "own_opponent_form",
    f"""
    WITH {GAMES_SQL},
    formed AS (SELECT game, team,
      {r2("LAG(pointsFor) OVER (PARTITION BY team ORDER BY d, game)")} AS p,
      {r2("AVG(pointsFor) OVER (PARTITION BY team ORDER BY d, game ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS a3,
      {r2("AVG(pointsFor) OVER (PARTITION BY team ORDER BY d, game ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS a7
      FROM games)
    SELECT g.game, g.team, g.opponent, f.p AS "own_opponent_previous_pointsFor",
      f.a3 AS "own_opponent_average_pointsFor_last_3_games", f.a7 AS "own_opponent_average_pointsFor_last_7_games"
    FROM games g LEFT JOIN formed f ON g.game = f.game AND g.opponent = f.team""",
)
def own_opponent(spark, folder):
    games = nation_games(spark, folder).select("game", "d", "team", "opponent", "pointsFor")
    bound = row_bound(spark, folder, "orders", 2)
    formed = own_opponent_form(games, "team", "opponent", "game", ["d", "game"], ["pointsFor"], bounded_by=bound)
    return formed.drop("d", "pointsFor")


_SEASON = "PARTITION BY o_custkey, YEAR(o_orderdate) ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING"


@query(
    "running_sum_per_game",
    f"""
    SELECT o_orderkey, season, n_season, rolling_o_totalprice, {r2("rolling_o_totalprice / n_season")} AS rolling_per_game_o_totalprice,
      all_time, CASE WHEN n_season > 3 THEN 1 ELSE 0 END AS is_playoff
    FROM (SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS season, COUNT(o_orderkey) OVER ({_SEASON}) AS n_season,
      {r2(f"SUM(o_totalprice) OVER ({_SEASON})")} AS rolling_o_totalprice,
      {r2(f"SUM(o_totalprice) OVER ({BY_CUSTOMER} ROWS UNBOUNDED PRECEDING)")} AS all_time FROM orders) t""",
)
def running_sum_per_game(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").withColumn(
        "season", F.year("o_orderdate")
    )
    order, bound = ["o_orderdate", "o_orderkey"], row_bound(spark, folder, "orders")
    counted = games_played(orders, ["o_custkey", "season"], order, "o_orderkey", "n_season", bounded_by=bound)
    summed = running_totals(
        counted, ["o_custkey", "season"], order, ["o_totalprice"], games="n_season", bounded_by=bound
    )
    total = over_ordered(summed, ["o_custkey"], order, [Running("_t", F.col("o_totalprice"))], bounded_by=bound)
    return total.select(
        "o_orderkey",
        "season",
        "n_season",
        "rolling_o_totalprice",
        "rolling_per_game_o_totalprice",
        round_half_up("_t").alias("all_time"),
        playoff_flag("n_season", 3).alias("is_playoff"),
    )


@query(
    "ratio_per_opportunity",
    f"""
    WITH per_order AS (
      SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned, SUM(l_quantity) AS qty,
        SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS chances FROM lineitem GROUP BY l_orderkey),
    rolled AS (SELECT o_orderkey, returned, qty,
      SUM(returned) OVER ({BY_CUSTOMER} ROWS UNBOUNDED PRECEDING) AS r, SUM(chances) OVER ({BY_CUSTOMER} ROWS UNBOUNDED PRECEDING) AS c
      FROM orders JOIN per_order ON o_orderkey = l_orderkey)
    SELECT o_orderkey, {r2("CAST(r AS DOUBLE) / NULLIF(c, 0)")} AS returned_per_chance, {r2("CAST(returned AS DOUBLE) / NULLIF(qty, 0)")} AS returned_share
    FROM rolled""",
)
def ratio_per_opportunity(spark, folder):
    lines = table(spark, folder, "lineitem")
    sums = lines.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).alias("returned"),
        F.sum("l_quantity").alias("qty"),
        F.count_if(F.col("l_returnflag") == "N").alias("chances"),
    )
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate")
    joined = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    rolled = running_totals(
        joined, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["returned", "chances"], bounded_by=[orders]
    )
    return rolled.select(
        "o_orderkey",
        ratio("rolling_returned", "rolling_chances").alias("returned_per_chance"),
        ratio("returned", "qty").alias("returned_share"),
    )


@query(
    "lag_keeps_nulls",
    f"""
    SELECT o_orderkey, LAG(price) OVER ({BY_CUSTOMER}) AS lag_price FROM (SELECT *, {KNOWN_PRICE} AS price FROM orders) t""",
)
def lag_keeps_nulls(spark, folder):
    orders = _priced(spark, folder)
    return previous_row(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["price"], bounded_by=row_bound(spark, folder, "orders")
    ).select("o_orderkey", "lag_price")


@query(
    "group_median",
    """
    SELECT l_returnflag, l_linestatus, CAST(MEDIAN(l_extendedprice) AS DOUBLE) AS median_price, CAST(MEDIAN(l_quantity) AS DOUBLE) AS median_quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def median_by_group(spark, folder):
    lines = table(spark, folder, "lineitem")
    measures = {"l_extendedprice": "median_price", "l_quantity": "median_quantity"}
    return group_median(lines, ["l_returnflag", "l_linestatus"], measures, bounded_by=[lines])


def _user_days(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return events.withColumn("d", F.to_date("ts"))


@query(
    "season_hit_rate",
    f"""
    WITH e AS (SELECT *, CAST(ts AS DATE) AS d,
      COUNT(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events)
    SELECT event_id, CAST(n AS BIGINT) AS n,
      CASE WHEN n > 1 THEN {r2("CAST(SUM(CASE WHEN value >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY d) AS DOUBLE) / n", 4)} END AS hit_rate_20plus,
      CASE WHEN n > 1 THEN {r2("CAST(SUM(CASE WHEN value >= 60 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY d) AS DOUBLE) / n", 4)} END AS hit_rate_60plus
    FROM e""",
)
def season_hits(spark, folder):
    events = _user_days(spark, folder)
    bound = row_bound(spark, folder, "events")
    counted = games_played(events, ["user_id"], ["ts", "event_id"], "event_id", "n", bounded_by=bound)
    rated = season_hit_rate(counted, ["user_id"], "d", "value", "n", thresholds=(20, 60), bounded_by=bound)
    return rated.drop("user_id", "ts", "value", "d")


def _recent_sql(entity, row_id, source, value, low, high, days):
    frame = f"(PARTITION BY {entity} ORDER BY d RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND CURRENT ROW)"
    rates = ", ".join(
        r2(f"AVG(CASE WHEN {value} >= {t} THEN 1.0 ELSE 0.0 END) OVER {frame}", 4) + f" AS last{days}_hit_rate_{t}plus"
        for t in (low, high)
    )
    return f"SELECT {row_id}, {rates} FROM ({source}) t"


@query(
    "hit_rate_30d",
    _recent_sql(
        "c_nationkey",
        "o_orderkey",
        "SELECT o_orderkey, c_nationkey, o_totalprice, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey",
        "o_totalprice",
        200000,
        300000,
        30,
    ),
)
def hit_rate_month(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rated = hit_rate_last_days(rows, ["c_nationkey"], "o_orderdate", "o_totalprice", 30, (200000, 300000))
    return rated.select("o_orderkey", "last30_hit_rate_200000plus", "last30_hit_rate_300000plus")


@query(
    "hit_rate_7d",
    _recent_sql(
        "user_id",
        "event_id",
        "SELECT *, CAST(ts AS DATE) AS d FROM events",
        "value",
        20,
        60,
        7,
    ),
)
def hit_rate_week(spark, folder):
    events = table(spark, folder, "events")
    days = events.select("event_id", "user_id", "value", F.to_date("ts").alias("d"))
    return hit_rate_last_days(days, ["user_id"], "d", "value", days=7, thresholds=(20, 60)).drop(
        "user_id", "value", "d"
    )
