"""Named queries over the star tables, each beside its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.functions.dates import day_range
from formline.operators.schedule import expand_schedule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under a name with its SQL equivalent."""
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_bound(spark: SparkSession, folder: str, name: str, times: int = 1) -> int:
    """Upper bound of the rows derived from a base table, for ``bounded_by``."""
    return table(spark, folder, name).count() * times


def dated_orders(spark: SparkSession, folder: str, *columns: str, first=None, last=None) -> DataFrame:
    """Orders of the days [first, last] with a DATE ``o_orderdate`` and only the
    columns asked for."""
    orders = table(spark, folder, "orders")
    orders = orders.filter(day_range(orders, "o_orderdate", first, last)) if first or last else orders
    orders = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    return orders.select(*columns) if columns else orders


def r2(expression: str, digits: int = 2) -> str:
    """The SQL twin of ``round_half_up``."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def text(column: str) -> F.Column:
    return F.col(column).cast("string").alias(column)


# Orders as games between nations: the customer's nation plays at home against
# the nation of the order's lowest-numbered supplier. Points at home are whole
# thousands of the price, points away the summed quantity.
def slate_sql(source: str, order: str) -> str:
    """CTEs ``ordered`` and ``slate`` for a recursive WITH: games of ``source``
    (home, away) taken one by one in order, unless a team is in already."""
    return f"""
    ordered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS rn FROM {source}),
    slate(rn, seen, taken) AS (
      SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), FALSE
      UNION ALL
      SELECT o.rn, CASE WHEN list_contains(seen, o.home) OR list_contains(seen, o.away) THEN seen ELSE seen || [CAST(o.home AS BIGINT), CAST(o.away AS BIGINT)] END,
        NOT (list_contains(seen, o.home) OR list_contains(seen, o.away))
      FROM slate s JOIN ordered o ON o.rn = s.rn + 1
      WHERE len(seen) < (SELECT COUNT(*) - 1 FROM (SELECT home FROM ordered UNION SELECT away FROM ordered) t))"""


GAMES_SQL = """
first_supplier AS (SELECT l_orderkey, MIN(l_suppkey) AS suppkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey),
pairs AS (
  SELECT o_orderkey AS game, CAST(o_orderdate AS DATE) AS d, c_nationkey AS home, s_nationkey AS away, o_orderstatus AS status,
         CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS home_points, CAST(qty AS BIGINT) AS away_points
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN first_supplier ON o_orderkey = l_orderkey
  JOIN supplier ON suppkey = s_suppkey WHERE c_nationkey <> s_nationkey),
games AS (
  SELECT game, d, status, home AS team, away AS opponent, 'HOME' AS side, home_points AS pointsFor, away_points AS pointsAgainst FROM pairs
  UNION ALL
  SELECT game, d, status, away, home, 'AWAY', away_points, home_points FROM pairs)
"""


def nation_pairs(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("suppkey"), F.sum("l_quantity").alias("qty")
    )
    orders = dated_orders(
        spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        orders.join(first, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("suppkey") == F.col("s_suppkey"))
        .filter("c_nationkey <> s_nationkey")
    )
    return joined.select(
        F.col("o_orderkey").alias("game"),
        F.col("o_orderdate").alias("d"),
        F.col("c_nationkey").alias("home"),
        F.col("s_nationkey").alias("away"),
        F.col("o_orderstatus").alias("status"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("home_points"),
        F.col("qty").cast("long").alias("away_points"),
    )


def nation_games(spark: SparkSession, folder: str) -> DataFrame:
    """Two rows per game, one per nation."""
    doubled = expand_schedule(nation_pairs(spark, folder), "home", "away", "team", "opponent", "side")
    at_home = F.col("side") == "HOME"
    return doubled.select(
        "game",
        "d",
        "status",
        "team",
        "opponent",
        "side",
        F.when(at_home, F.col("home_points")).otherwise(F.col("away_points")).alias("pointsFor"),
        F.when(at_home, F.col("away_points")).otherwise(F.col("home_points")).alias("pointsAgainst"),
    )
