"""Splits and models over the star tables."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from formline.functions.numbers import round_half_up
from formline.operators.rolling import rolling_form
from formline.plans import models
from formline.plans.star.registry import dated_orders, query, r2, table
from formline.session import checkpoint_dir
from formline.sources.tables import solidify

_PARTS = "CASE WHEN place < 60 THEN 'train' WHEN place < 80 THEN 'validate' ELSE 'test' END"


@query(
    "split_by_time",
    f"""SELECT o_orderkey, {_PARTS} AS part FROM (SELECT o_orderkey, 100 * PERCENT_RANK() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS place FROM orders) t""",
)
def split_by_time(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_orderdate")
    return models.time_split(orders, "o_orderdate").drop("o_orderdate")


@query(
    "split_by_hash",
    f"""SELECT o_orderkey, {_PARTS} AS part FROM (SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7) AS BIGINT) % 100 AS place FROM orders) t""",
)
def split_by_hash(spark, folder):
    return models.hash_split(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "regression_metrics",
    f"""
    WITH p AS (SELECT o_totalprice / 1000 AS y, {r2("AVG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} / 1000 AS p FROM orders)
    SELECT COUNT(*) AS n, {r2("AVG((y - p) * (y - p))", 4)} AS mse, {r2("SQRT(AVG((y - p) * (y - p)))", 4)} AS rmse, {r2("AVG(ABS(y - p))", 4)} AS mae,
      {r2("1 - AVG((y - p) * (y - p)) / VAR_POP(y)", 4)} AS r2 FROM p WHERE p IS NOT NULL""",
)
def metrics(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    formed = rolling_form(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"], windows=[3], bounded_by=[orders]
    )
    rows = formed.select(
        (F.col("o_totalprice") / 1000).alias("y"), (F.col("average_o_totalprice_last_3_games") / 1000).alias("p")
    )
    return models.regression_metrics(rows, "y", "p")


def _written(spark, rows):
    """The rows as files, so that each step of a fit reads them and none runs the joins again."""
    return solidify(rows, f"{checkpoint_dir(spark).rstrip('/')}/training-{uuid.uuid4().hex}")


@query(
    "ml_score",
    f"""
    WITH a AS (SELECT l_orderkey, SUM(l_extendedprice) AS amount FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS y, amount FROM orders LEFT JOIN a ON o_orderkey = l_orderkey),
    m AS (SELECT AVG(amount) AS mean FROM o WHERE o_orderstatus <> 'O'),
    f AS (SELECT regr_slope(y, COALESCE(amount, mean)) AS b, regr_intercept(y, COALESCE(amount, mean)) AS c FROM o, m WHERE o_orderstatus <> 'O')
    SELECT o_orderkey, o_custkey, {r2("b * COALESCE(amount, mean) + c")} AS predicted FROM o, m, f WHERE o_orderstatus = 'O'""",
)
def ml_score(spark, folder):
    """A line fitted on played orders, scored on open ones."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("amount"))
    rows = _written(spark, orders.join(lines, "o_orderkey", "left"))
    line = LinearRegression(featuresCol="features", labelCol="o_totalprice", solver="normal")
    model = models.fit(rows.filter("o_orderstatus <> 'O'"), "o_totalprice", ["amount"], estimator=line)
    scored = models.score(model, rows.filter("o_orderstatus = 'O'"), keep=["o_orderkey", "o_custkey"])
    return scored.withColumn("predicted", round_half_up("predicted"))


def _gapped_customers(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    return customers.select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("area")
    )


@query(
    "feature_codes",
    f"""
    WITH g AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS x, c_mktsegment AS seg, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS area FROM customer),
    i AS (SELECT *, COALESCE(x, (SELECT AVG(x) FROM g)) AS v FROM g),
    s AS (SELECT AVG(v) AS mean, STDDEV_SAMP(v) AS dev FROM i)
    SELECT c_custkey, {r2("(v - mean) / dev", 4)} AS scaled, CAST(DENSE_RANK() OVER (ORDER BY area) - 1 AS DOUBLE) AS ordinal, CAST(DENSE_RANK() OVER (ORDER BY seg) - 1 AS INT) AS hot FROM i, s""",
)
def feature_codes(spark, folder):
    """Mean-imputed and standardized balances, ordinal codes and one-hot places."""
    rows = _gapped_customers(spark, folder)
    stages = models.feature_stages(["c_acctbal"], one_hot=["c_mktsegment"], ordinal=["area"])
    slots = vector_to_array("features")
    coded = Pipeline(stages=stages).fit(rows).transform(rows).select("c_custkey", slots.alias("f"))
    return coded.select(
        "c_custkey", round_half_up(F.col("f")[0], 4).alias("scaled"), F.col("f")[1].alias("ordinal"),
        (F.array_position(F.slice("f", 3, 100), 1.0) - 1).cast("int").alias("hot"),
    )


@query(
    "unseen_codes",
    f"""
    WITH g AS (SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS area FROM customer), k AS (SELECT DISTINCT area FROM g WHERE area < '20'),
    r AS (SELECT area, ROW_NUMBER() OVER (ORDER BY area) - 1 AS code FROM k)
    SELECT c_custkey, CAST(COALESCE(code, (SELECT COUNT(*) FROM k)) AS DOUBLE) AS code FROM g LEFT JOIN r ON g.area = r.area""",
)
def unseen_codes(spark, folder):
    """Ordinal codes learnt from some areas; the others share a code of their own."""
    rows = _gapped_customers(spark, folder).withColumn("one", F.lit(1.0) + F.col("c_custkey") % 2)
    model = Pipeline(stages=models.feature_stages(["one"], ordinal=["area"])).fit(rows.filter("area < '20'"))
    return model.transform(rows).select("c_custkey", vector_to_array("features")[1].alias("code"))
