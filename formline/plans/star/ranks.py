"""Ranks, latest flags and percentiles over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators.ranking import (
    latest_date_flag,
    latest_flag,
    newest_first_counter,
    ordinal_percentile,
    rank_form,
    usage_rank,
)
from formline.operators.rolling import games_played, running_totals
from formline.plans.reports import season_averages
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_games, query, r2, row_bound, table


def _ranked(measure, direction, within):
    order = f"(PARTITION BY {within} ORDER BY {measure} {direction} NULLS LAST)"
    return f"""RANK() OVER {order} AS "rank_{measure}", {r2(f"1 - PERCENT_RANK() OVER {order}")} AS "perc_rank_{measure}" """


@query(
    "rank_direction_aware",
    f"""
    WITH t AS (SELECT o_custkey, CAST(YEAR(o_orderdate) AS INTEGER) AS season, COUNT(*) AS "ordersFor",
      SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS "pendingAgainst" FROM orders GROUP BY 1, 2)
    SELECT o_custkey, season, {_ranked("ordersFor", "DESC", "season")}, {_ranked("pendingAgainst", "ASC", "season")} FROM t""",
)
def rank_direction_aware(spark, folder):
    orders = dated_orders(spark, folder, "o_custkey", "o_orderdate", "o_orderstatus")
    totals = orders.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).alias("ordersFor"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pendingAgainst"),
    )
    ranked = rank_form(totals, ["season"], ["ordersFor", "pendingAgainst"], bounded_by=[orders])
    return ranked.drop("ordersFor", "pendingAgainst")


@query(
    "rank_by_games_played",
    f"""
    WITH {GAMES_SQL},
    r AS (SELECT game, team, COUNT(*) OVER w AS n, {r2("SUM(pointsFor) OVER w / CAST(COUNT(*) OVER w AS DOUBLE)")} AS "perGameFor",
      {r2("SUM(pointsAgainst) OVER w / CAST(COUNT(*) OVER w AS DOUBLE)")} AS "perGameAgainst" FROM games
      WINDOW w AS (PARTITION BY team ORDER BY d, game ROWS UNBOUNDED PRECEDING))
    SELECT game, team, n, "perGameFor", "perGameAgainst", {_ranked("perGameFor", "DESC", "n")}, {_ranked("perGameAgainst", "ASC", "n")} FROM r""",
)
def rank_by_games_played(spark, folder):
    games = nation_games(spark, folder)
    bound = row_bound(spark, folder, "orders", 2)
    counted = games_played(games, ["team"], ["d", "game"], "game", "n", bounded_by=bound)
    rolled = running_totals(
        counted, ["team"], ["d", "game"], ["pointsFor", "pointsAgainst"], games="n", bounded_by=bound
    )
    rates = rolled.select(
        "game",
        "team",
        "n",
        F.col("rolling_per_game_pointsFor").alias("perGameFor"),
        F.col("rolling_per_game_pointsAgainst").alias("perGameAgainst"),
    )
    return rank_form(rates, ["n"], ["perGameFor", "perGameAgainst"], bounded_by=bound)


@query(
    "usage_rank_in_game",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      RANK() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC NULLS LAST) AS usage_rank FROM lineitem""",
)
def usage_rank_in_game(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return usage_rank(lines, ["l_orderkey"], "l_quantity", "usage_rank", bounded_by=[lines])


@query(
    "latest_flag",
    """
    SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1
      THEN 1 ELSE 0 END AS is_latest FROM orders""",
)
def latest_order_flag(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate")
    return latest_flag(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "is_latest", bounded_by=[orders]
    ).select("o_orderkey", "is_latest")


@query(
    "latest_date_flag",
    f"""
    WITH {GAMES_SQL}
    SELECT game, team, CASE WHEN d = MAX(d) OVER (PARTITION BY team) THEN 1 ELSE 0 END AS is_latest_date FROM games""",
)
def latest_team_date_flag(spark, folder):
    games = nation_games(spark, folder).select("game", "team", "d")
    return latest_date_flag(games, ["team"], "d", "is_latest_date").drop("d")


@query(
    "latest_matchup_counter",
    f"""
    WITH {GAMES_SQL},
    c AS (SELECT game, team, ROW_NUMBER() OVER (PARTITION BY team, opponent ORDER BY d DESC, game DESC) AS counter FROM games)
    SELECT game, team, counter, CASE WHEN counter >= 2 THEN 1 ELSE 0 END AS met_before FROM c""",
)
def latest_matchup_counter(spark, folder):
    games = nation_games(spark, folder).select("game", "team", "opponent", "d")
    counted = newest_first_counter(
        games, ["team", "opponent"], [F.col("d").desc(), F.col("game").desc()], "counter", flag="met_before",
        bounded_by=row_bound(spark, folder, "orders", 2),
    )
    return counted.select("game", "team", "counter", F.col("met_before").cast("int").alias("met_before"))


@query(
    "ordinal_percentile",
    f"""
    WITH a AS (SELECT o_custkey, {r2("AVG(o_totalprice)")} AS avg_price FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 5),
    p AS (SELECT *, ROW_NUMBER() OVER (ORDER BY avg_price DESC, o_custkey) AS i, COUNT(*) OVER () AS n FROM a)
    SELECT o_custkey, avg_price, CASE WHEN n <= 1 THEN 0.5 ELSE {r2("CAST(n - i AS DOUBLE) / (n - 1)", 4)} END AS percentile FROM p""",
)
def season_percentile(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_totalprice")
    averages = season_averages(orders, "o_custkey", "o_orderkey", {"o_totalprice": "avg_price"}, min_games=5)
    ranked = ordinal_percentile(
        averages.select("o_custkey", "avg_price"), [F.col("avg_price").desc(), F.col("o_custkey")], "percentile", bounded_by=[orders]
    )
    return ranked
