"""Quality reports over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions.numbers import ratio, round_half_up
from formline.operators.quality import (
    bucket_histogram,
    categorical_cardinality,
    completeness,
    distinct_keys,
    duplicate_groups,
    expect,
    feature_summary,
    freshness,
    key_uniqueness,
    layer_profile,
    max_per_entity,
    out_of_range,
    readiness_report,
)
from formline.plans.star.registry import dated_orders, query, r2, table


@query(
    "dup_groups",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n, COUNT(*) - 1 AS surplus FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def dup_groups(spark, folder):
    return duplicate_groups(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "key_uniqueness",
    "SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(n - 1) AS BIGINT) AS surplus FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) t",
)
def uniqueness(spark, folder):
    return key_uniqueness(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "distinct_keys_with_nulls",
    """
    SELECT o_orderstatus, COUNT(*) AS n FROM (SELECT DISTINCT o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS p, YEAR(o_orderdate) AS y FROM orders) t GROUP BY 1""",
)
def distinct_with_nulls(spark, folder):
    orders = dated_orders(spark, folder, "o_orderstatus", "o_orderpriority", "o_orderdate").select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("p"),
        F.year("o_orderdate").alias("y"),
    )
    return orders.groupBy("o_orderstatus").agg(distinct_keys(["p", "y"]).alias("n"))


@query(
    "completeness",
    f"""
    WITH j AS (SELECT o_orderkey, q, p FROM orders LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS q, MAX(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS p FROM lineitem GROUP BY 1) t
      ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O')
    SELECT COUNT(*) AS n_rows, {r2("CAST(COUNT(q) AS DOUBLE) / COUNT(*)", 4)} AS q_filled, {r2("CAST(COUNT(p) AS DOUBLE) / COUNT(*)", 4)} AS p_filled,
      LEAST({r2("CAST(COUNT(q) AS DOUBLE) / COUNT(*)", 4)}, {r2("CAST(COUNT(p) AS DOUBLE) / COUNT(*)", 4)}) AS worst_filled FROM j""",
)
def completeness_of_open(spark, folder):
    sums = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("q"), F.max(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("p")
    )
    joined = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus").join(sums, "o_orderkey", "left")
    return completeness(joined, ["q", "p"], F.col("o_orderstatus") == "O")


@query(
    "range_check",
    """
    SELECT CAST(SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS l_discount_out, CAST(SUM(CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 1 ELSE 0 END) AS BIGINT) AS l_quantity_out,
      CAST(SUM(CASE WHEN l_discount > 0.05 OR l_quantity < 5 OR l_quantity > 45 THEN 1 ELSE 0 END) AS BIGINT) AS rows_out FROM lineitem""",
)
def range_check(spark, folder):
    return out_of_range(table(spark, folder, "lineitem"), {"l_discount": (None, 0.05), "l_quantity": (5, 45)})


@query(
    "freshness",
    """
    SELECT CAST(MAX(CAST(o_orderdate AS DATE)) AS VARCHAR) AS max_date, CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS upcoming_rows,
      CASE WHEN MAX(CAST(o_orderdate AS DATE)) >= DATE '2001-07-01' THEN 1 ELSE 0 END AS is_fresh FROM orders""",
)
def fresh(spark, folder):
    orders = dated_orders(spark, folder, "o_orderdate", "o_orderstatus")
    report = freshness(orders, "o_orderdate", F.lit("2001-07-01").cast("date"), F.col("o_orderstatus") == "O")
    return report.withColumn("max_date", F.col("max_date").cast("string"))


@query(
    "max_upcoming_per_entity",
    "SELECT MAX(n) AS max_rows FROM (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) t",
)
def max_upcoming(spark, folder):
    return max_per_entity(table(spark, folder, "orders"), ["o_custkey"], F.col("o_orderstatus") == "O")


@query(
    "readiness_report",
    f"""
    WITH a AS (SELECT COUNT(*) AS n, SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS o, AVG(o_totalprice) AS p FROM orders)
    SELECT 'rows' AS "check", CAST(n AS DOUBLE) AS value, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status, '> 0' AS expectation FROM a
    UNION ALL SELECT 'upcoming share', {r2("CAST(o AS DOUBLE) / n", 4)}, CASE WHEN CAST(o AS DOUBLE) / n < 0.1 THEN 'PASS' ELSE 'FAIL' END, '< 0.1' FROM a
    UNION ALL SELECT 'mean price', {r2("p")}, CASE WHEN p BETWEEN 1 AND 1000000 THEN 'PASS' ELSE 'FAIL' END, '1 to 1000000' FROM a""",
)
def readiness(spark, folder):
    count = F.count(F.lit(1))
    checks = [
        ("rows", count, lambda v: v > 0, "> 0"),
        ("upcoming share", ratio(F.count_if(F.col("o_orderstatus") == "O"), count, 4), lambda v: v < 0.1, "< 0.1"),
        ("mean price", round_half_up(F.avg("o_totalprice")), lambda v: v.between(1, 1000000), "1 to 1000000"),
    ]
    return readiness_report(table(spark, folder, "orders"), checks)


def _profile_sql(name, keys, date):
    low, high = (f"CAST({f}(CAST({date} AS DATE)) AS VARCHAR)" if date else "NULL" for f in ("MIN", "MAX"))
    return f"""SELECT '{name}' AS layer, COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM {name}) d) AS n_keys,
      {low} AS min_date, {high} AS max_date FROM {name}"""


_LAYERS = {
    "orders": ("o_orderkey", "o_orderdate"),
    "lineitem": ("l_orderkey, l_linenumber", "l_shipdate"),
    "events": ("event_id", "ts"),
    "customer": ("c_custkey", None),
}


@query("layer_profile", " UNION ALL ".join(_profile_sql(n, k, d) for n, (k, d) in _LAYERS.items()))
def profile(spark, folder):
    return layer_profile({n: (table(spark, folder, n), k.split(", "), d) for n, (k, d) in _LAYERS.items()})


@query(
    "bucket_histogram",
    """
    SELECT CASE WHEN value IS NULL THEN 'null' WHEN value < 10 THEN 'under 10' WHEN value < 50 THEN '10 to 50' WHEN value < 200 THEN '50 to 200' ELSE '200 up' END AS bucket, COUNT(*) AS n FROM events GROUP BY 1""",
)
def histogram(spark, folder):
    edges = [("under 10", 10), ("10 to 50", 50), ("50 to 200", 200), ("200 up", None)]
    return bucket_histogram(table(spark, folder, "events"), "value", edges)


def _summary_sql(c):
    return f"""SELECT '{c}' AS feature, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, CAST(MIN({c}) AS DOUBLE) AS min_value,
      {r2(f"AVG(CAST({c} AS DOUBLE))", 4)} AS mean_value, CAST(MAX({c}) AS DOUBLE) AS max_value FROM lineitem"""


@query("feature_summary", " UNION ALL ".join(_summary_sql(c) for c in ("l_quantity", "l_discount", "l_linenumber")))
def summary(spark, folder):
    return feature_summary(table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_linenumber"])


@query(
    "categorical_cardinality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT(DISTINCT {c}) AS n_values FROM part" for c in ("p_brand", "p_type", "p_size")
    ),
)
def cardinality(spark, folder):
    return categorical_cardinality(table(spark, folder, "part"), ["p_brand", "p_type", "p_size"])


@query(
    "expect_or_drop",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 10000 AND o_orderstatus IN ('O', 'F')",
)
def expect_or_drop(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    rules = {"priced": "o_totalprice > 10000", "known status": "o_orderstatus IN ('O', 'F')"}
    return expect(orders, rules).drop("o_orderstatus")


@query(
    "expect_report",
    """
    SELECT o_orderkey, (CASE WHEN o_totalprice > 10000 THEN 0 ELSE 1 END) + (CASE WHEN o_orderstatus IN ('O', 'F') THEN 0 ELSE 1 END) AS n_failed FROM orders""",
)
def expect_report(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    rules = {"priced": "o_totalprice > 10000", "known status": "o_orderstatus IN ('O', 'F')"}
    return expect(orders, rules, "report").select("o_orderkey", F.size("failed_rules").alias("n_failed"))


@query(
    "breakdown_by_season",
    f"""
    SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS season, CASE WHEN o_orderstatus = 'O' THEN 'upcoming' ELSE 'played' END AS kind, COUNT(*) AS n, {r2("AVG(o_totalprice)")} AS mean_price,
      {r2("SUM(o_totalprice)")} AS total_price FROM orders GROUP BY 1, 2""",
)
def breakdown(spark, folder):
    orders = dated_orders(spark, folder, "o_orderdate", "o_orderstatus", "o_totalprice")
    kind = F.when(F.col("o_orderstatus") == "O", "upcoming").otherwise("played")
    return orders.groupBy(F.year("o_orderdate").alias("season"), kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(F.avg("o_totalprice")).alias("mean_price"),
        round_half_up(F.sum("o_totalprice")).alias("total_price"),
    )
