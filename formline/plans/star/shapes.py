"""Pivots, slices, clean-up and unions over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions.dates import date_as_int, day_label, day_number, parse_date, season_by_boundaries, season_code, within_days
from formline.functions.numbers import at_least, gap, zero_if_null_when
from formline.functions.text import clean_id, collapse_spaces, composite_id, contains_ignoring_case, lookup_code, prompt_text, with_comments
from formline.operators.schedule import home_and_away
from formline.operators.shape import (
    pick_columns,
    pivot_situation,
    prefix_columns,
    reorder_columns,
    season_totals,
    situation_slice,
    swap_view,
    sums_plus_each,
    typed_nulls,
    union_all,
    union_distinct,
    unpivot_points,
    zero_fill_counts,
)
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_games, query, r2, table


def _situations(spark, folder):
    """Per order and return flag, with an "all" situation, as in game facts."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_quantity").alias("qty"), F.lit(1).cast("long").alias("n_lines"))
    return sums_plus_each(lines, ["l_orderkey"], "l_returnflag", ["qty", "n_lines"])


_SITUATIONS_SQL = """
situations AS (
  SELECT l_orderkey, l_returnflag, SUM(l_quantity) AS qty, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey, l_returnflag
  UNION ALL SELECT l_orderkey, 'all', SUM(l_quantity), COUNT(*) FROM lineitem GROUP BY l_orderkey)"""


@query("situation_all_plus_each", f"WITH {_SITUATIONS_SQL} SELECT * FROM situations")
def situation_all_plus_each(spark, folder):
    return _situations(spark, folder)


@query(
    "situation_pivot",
    f"""
    WITH {_SITUATIONS_SQL}
    SELECT a.l_orderkey, a.qty AS "game_Total_qty", a.n_lines AS "game_Total_n_lines", r.qty AS "game_Returned_qty", r.n_lines AS "game_Returned_n_lines",
      n.qty AS "game_New_qty", n.n_lines AS "game_New_n_lines"
    FROM (SELECT * FROM situations WHERE l_returnflag = 'all') a
    LEFT JOIN (SELECT * FROM situations WHERE l_returnflag = 'R') r ON a.l_orderkey = r.l_orderkey
    LEFT JOIN (SELECT * FROM situations WHERE l_returnflag = 'N') n ON a.l_orderkey = n.l_orderkey""",
)
def situation_pivot(spark, folder):
    mapping = {"all": "Total", "R": "Returned", "N": "New"}
    return pivot_situation(
        _situations(spark, folder), ["l_orderkey"], "l_returnflag", mapping, ["qty", "n_lines"], "game_", base="all"
    )


@query(
    "situation_slice",
    """
    SELECT l_orderkey, CAST(l_shipdate AS DATE)::VARCHAR AS l_shipdate, l_quantity AS "line_l_quantity", l_extendedprice AS "line_l_extendedprice"
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IN ('O')""",
)
def slice_of_lines(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyyMMdd"))
    cut = situation_slice(
        lines,
        ["l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice"],
        "line_",
        "R",
        situation="l_returnflag",
        keys=["l_orderkey"],
        date="l_shipdate",
        season=("l_linestatus", ["O"]),
    )
    return cut.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query(
    "points_unpivot",
    """
    SELECT o_orderkey, 'Price' AS label, o_totalprice AS value FROM orders
    UNION ALL SELECT o_orderkey, 'Customer', CAST(o_custkey AS DOUBLE) FROM orders
    UNION ALL SELECT o_orderkey, 'Year', CAST(YEAR(o_orderdate) AS DOUBLE) FROM orders""",
)
def points_unpivot(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_totalprice", "o_custkey", "o_orderdate")
    wide = orders.withColumn("year", F.year("o_orderdate")).drop("o_orderdate")
    return unpivot_points(wide, ["o_orderkey"], {"o_totalprice": "Price", "o_custkey": "Customer", "year": "Year"})


@query(
    "date_normalize",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS as_int,
      CAST(strftime(o_orderdate, '%a') || '.' AS VARCHAR) AS day, CAST(ISODOW(o_orderdate) AS INTEGER) AS day_no,
      CAST((YEAR(o_orderdate) - CASE WHEN MONTH(o_orderdate) < 7 THEN 1 ELSE 0 END) * 10001 + 1 AS INTEGER) AS season,
      CAST(CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 1999 WHEN o_orderdate >= DATE '1997-01-01' THEN 1997 ELSE 1900 END AS INTEGER) AS era,
      CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') <= 30 THEN 1 ELSE 0 END AS is_recent
    FROM orders""",
)
def date_normalize(spark, folder):
    """Dates are written in five spellings first, one of them unreadable, and
    every readable one must parse back."""
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    spelled = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "yyyyMMdd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "M/d/yyyy"))
        .otherwise(F.date_format(d, "M/d/yy"))
    )
    formats = ("yyyyMMdd", "yyyy-MM-dd", "M/d/yyyy")
    century = F.when(F.year(d) >= 2000, parse_date(spelled, ("M/d/yy",))).otherwise(d)
    parsed = F.coalesce(parse_date(spelled, formats), century)
    rows = orders.withColumn("p", F.when(F.col("o_orderkey") % 4 == 3, century).otherwise(parsed))
    return rows.select(
        "o_orderkey",
        F.col("p").cast("string").alias("parsed"),
        date_as_int("p").alias("as_int"),
        day_label("p").alias("day"),
        day_number("p").alias("day_no"),
        season_code("p").alias("season"),
        season_by_boundaries("p", {"1997-01-01": 1997, "1999-01-01": 1999}, 1900).cast("int").alias("era"),
        within_days("p", 30, F.lit("2001-08-01").cast("date")).cast("int").alias("is_recent"),
    )


@query(
    "id_cleanup",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, YEAR(o_orderdate) || '0' || o_orderkey AS composite,
      CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' ELSE 'Unknown' END AS status_name,
      regexp_replace(o_orderpriority, '-', ' ', 'g') AS priority, CASE WHEN o_orderpriority ILIKE '%urg%' THEN 1 ELSE 0 END AS is_urgent
    FROM orders""",
)
def id_cleanup(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    floated = orders.withColumn("raw", F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")))
    wide = F.concat(F.lit("  "), F.regexp_replace("o_orderpriority", "-", " \t  "))
    return floated.select(
        clean_id("raw").alias("id"),
        composite_id(F.year("o_orderdate"), clean_id("raw")).alias("composite"),
        lookup_code("o_orderstatus", {"O": "Open", "F": "Finished"}).alias("status_name"),
        collapse_spaces(wide).alias("priority"),
        contains_ignoring_case("o_orderpriority", "URG").cast("int").alias("is_urgent"),
    )


@query(
    "zero_fill_rules",
    """
    WITH r AS (SELECT l_orderkey, SUM(l_quantity) AS q, MAX(l_linenumber) AS k FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT o_orderkey, COALESCE(q, 0) AS "player_qty", k AS "player_qtyRank", CASE WHEN o_orderstatus <> 'O' THEN COALESCE(q, 0) ELSE q END AS qty_if_played,
      CASE WHEN q >= 30 THEN 1 WHEN q IS NOT NULL THEN 0 END AS q30, CAST(NULL AS VARCHAR) AS note
    FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""",
)
def zero_fill_rules(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("player_qty"), F.max("l_linenumber").alias("player_qtyRank")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    joined = orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    judged = joined.select(
        "*",
        zero_if_null_when(F.col("o_orderstatus") != "O", "player_qty").alias("qty_if_played"),
        at_least("player_qty", 30).alias("q30"),
    )
    return typed_nulls(zero_fill_counts(judged, ["player_"]), {"note": "string"}).drop("o_orderstatus")


@query(
    "column_rules",
    """
    SELECT n_name AS "index_n_name", n_nationkey AS "index_n_nationkey", r_name AS "index_r_name" FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def column_rules(spark, folder):
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    ordered = reorder_columns(joined, ["r_name", "n_name", "absent", "n_name"])
    return prefix_columns(pick_columns(ordered, keep=["r_name"], starts=["n_name"], contains=["nationkey"]), "index_")


@query(
    "swap_perspective",
    f"""
    WITH {GAMES_SQL}
    SELECT game, side, CASE WHEN side = 'HOME' THEN team ELSE opponent END AS home, CASE WHEN side = 'HOME' THEN opponent ELSE team END AS away,
      CASE WHEN side = 'HOME' THEN pointsFor ELSE pointsAgainst END AS home_points,
      CASE WHEN side = 'HOME' THEN pointsAgainst ELSE pointsFor END AS away_points,
      ABS({r2("pointsFor - pointsAgainst")}) AS gap FROM games""",
)
def swap_perspective(spark, folder):
    games = nation_games(spark, folder)
    home, away = home_and_away("team", "opponent", "side")
    coded = games.select("*", home.alias("home"), away.alias("away"), gap("pointsFor", "pointsAgainst").alias("gap"))
    swapped = swap_view(coded, F.col("side") == "AWAY", [("pointsFor", "pointsAgainst")])
    return swapped.select(
        "game", "side", "home", "away", F.col("pointsFor").alias("home_points"), F.col("pointsAgainst").alias("away_points"), "gap"
    )


@query(
    "unions",
    """
    SELECT n_nationkey AS code, n_name AS name, CAST(NULL AS DOUBLE) AS balance FROM nation
    UNION ALL SELECT s_nationkey, s_name, s_acctbal FROM supplier
    UNION ALL SELECT code, NULL, NULL FROM (SELECT c_nationkey AS code FROM customer UNION SELECT s_nationkey FROM supplier) d""",
)
def unions(spark, folder):
    supplier = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    sellers = supplier.select(F.col("s_nationkey").alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    used = union_distinct(
        table(spark, folder, "customer").select(F.col("c_nationkey").alias("code")),
        supplier.select(F.col("s_nationkey").alias("code")),
    )
    return union_all(nations, sellers, used)


@query(
    "prompt_text",
    """
    SELECT c_custkey, 'Explain this customer.' || chr(10) || 'c_custkey:' || chr(10) || 'c_name: Name' || chr(10) || 'c_mktsegment: Market segment' || chr(10)
      || '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS prompt FROM customer""",
)
def prompts(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    noted = with_comments(customer, {"c_name": "Name", "c_mktsegment": "Market segment"})
    return prompt_text(noted, "Explain this customer.").select("c_custkey", "prompt")


@query(
    "season_totals",
    """
    SELECT l_suppkey, l_returnflag, SUM(l_quantity) AS "total_l_quantity", COUNT(DISTINCT l_orderkey) AS games_played FROM lineitem GROUP BY 1, 2""",
)
def totals_of_suppliers(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_quantity")
    return season_totals(lines, ["l_suppkey", "l_returnflag"], ["l_quantity"], "l_orderkey", "total_")
