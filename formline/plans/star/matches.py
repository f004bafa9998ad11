"""Joins with a twist over the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from formline.operators.lastknown import latest_per_key
from formline.operators.matching import (
    left_join_bounded,
    lookup,
    nearest_date,
    opponent_totals,
    reconcile,
    two_tier_lookup,
    with_pair,
)
from formline.operators.rolling import rolling_form
from formline.operators.vectors import build_vector_index, index_top_k, mean_vectors, recall, vector_top_k
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_games, nation_pairs, query, r2, table, text
from formline.session import checkpoint_dir


@query(
    "nearest_date_match",
    """
    WITH p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'click'),
    c AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS cd FROM events WHERE event_type = 'purchase')
    SELECT event_id, CAST(cd AS VARCHAR) AS nearest FROM (
      SELECT event_id, cd, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ABS(date_diff('day', d, cd)), cd) AS rn FROM p LEFT JOIN c ON p.user_id = c.user_id) t WHERE rn = 1""",
)
def nearest_date_match(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    clicks = events.filter("event_type = 'click'").drop("event_type")
    bought = events.filter("event_type = 'purchase'").select("user_id", F.col("d").alias("bought"))
    matched = nearest_date(clicks, bought, ["user_id"], "d", "bought", alias="nearest")
    return matched.select("event_id", text("nearest"))


@query(
    "two_tier_lookup",
    """
    WITH byid AS (SELECT o_custkey, MAX(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS v FROM orders GROUP BY o_custkey),
    bynation AS (SELECT c_nationkey, MAX(c_acctbal) AS v FROM customer GROUP BY c_nationkey)
    SELECT c_custkey, CASE WHEN i.o_custkey IS NOT NULL THEN i.v ELSE n.v END AS v, CASE WHEN i.o_custkey IS NOT NULL THEN 1 WHEN n.c_nationkey IS NOT NULL THEN 2 END AS tier
    FROM customer c LEFT JOIN byid i ON c.c_custkey = i.o_custkey LEFT JOIN bynation n ON c.c_nationkey = n.c_nationkey""",
)
def tiered(spark, folder):
    customer = table(spark, folder, "customer")
    finished = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    by_id = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(finished).alias("v"))
    by_nation = customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("v"))
    asked = customer.select("c_custkey", "c_nationkey")
    found = two_tier_lookup(asked, by_id, ["c_custkey"], ["c_nationkey"], ["v"], "tier", second_table=by_nation)
    return found.drop("c_nationkey")


@query(
    "code_lookup",
    """SELECT s_suppkey, COALESCE(CASE WHEN n_regionkey <> 3 THEN n_name END, 'Unknown') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def code_lookup(spark, folder):
    """The nations of one region have no name."""
    nations = table(spark, folder, "nation").withColumn("n_name", F.when(F.col("n_regionkey") != 3, F.col("n_name")))
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return lookup(supplier, "s_nationkey", nations, "n_nationkey", "n_name", "nation").drop("s_nationkey")


@query(
    "either_order_pair",
    f"""
    WITH {GAMES_SQL}
    SELECT LEAST(home, away) AS pair_low, GREATEST(home, away) AS pair_high, COUNT(*) AS n, CAST(SUM(home_points) AS BIGINT) AS points FROM pairs GROUP BY 1, 2""",
)
def either_order_pair(spark, folder):
    paired = with_pair(nation_pairs(spark, folder), "home", "away")
    return paired.groupBy("pair_low", "pair_high").agg(F.count(F.lit(1)).alias("n"), F.sum("home_points").alias("points"))


@query(
    "opponent_totals",
    f"""
    WITH {GAMES_SQL}
    SELECT a.game, a.team, a.pointsFor, b.pointsFor AS allowed FROM games a LEFT JOIN games b ON a.game = b.game AND a.opponent = b.team""",
)
def opponents(spark, folder):
    games = nation_games(spark, folder).select("game", "team", "opponent", "pointsFor")
    return opponent_totals(games, "game", "team", "opponent", {"pointsFor": "allowed"}).drop("opponent")


@query(
    "exists_not_exists",
    """
    SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS has_urgent
    FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)""",
)
def exists_not_exists(spark, folder):
    orders = table(spark, folder, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    dear = orders.filter("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    modest = table(spark, folder, "customer").select("c_custkey").join(dear, "c_custkey", "left_anti")
    with_urgent = modest.join(urgent, "c_custkey", "left_semi").withColumn("has_urgent", F.lit(1))
    return with_urgent.unionByName(modest.join(urgent, "c_custkey", "left_anti").withColumn("has_urgent", F.lit(0)))


@query(
    "left_join_bounded",
    """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND CAST(o_orderdate AS DATE) >= DATE '2001-01-01'""",
)
def bounded_join(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate").withColumnRenamed("o_custkey", "c_custkey")
    customer = table(spark, folder, "customer").select("c_custkey")
    bound = F.col("o_orderdate") >= F.lit("2001-01-01").cast("date")
    return left_join_bounded(customer, orders, ["c_custkey"], bound).select("c_custkey", "o_orderkey")


@query(
    "reconcile_previous",
    f"""
    WITH x AS (SELECT o_orderkey, {r2("LAG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)")} AS p,
      o_orderstatus, o_orderpriority FROM orders),
    s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN p + 1 WHEN o_orderpriority = '5-LOW' THEN NULL ELSE p END AS stored, p FROM x)
    SELECT o_orderkey, stored AS "stored_previous_o_totalprice", p AS "source_previous_o_totalprice",
      CASE WHEN stored IS NULL AND p IS NULL THEN 'BOTH_NULL' WHEN stored IS NULL THEN 'MISSING_STORED' WHEN p IS NULL THEN 'MISSING_SOURCE'
           WHEN ABS(stored - p) <= 0.005 THEN 'MATCH' ELSE 'DIFFERENT' END AS verdict FROM s""",
)
def reconcile_previous(spark, folder):
    orders = dated_orders(
        spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    again = rolling_form(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"], windows=[], bounded_by=[orders]
    )
    name = "previous_o_totalprice"
    tampered = (
        F.when(F.col("o_orderstatus") == "P", F.col(name) + 1)
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.col(name))
    )
    return reconcile(again.withColumn(name, tampered), again, ["o_orderkey"], name)


@query(
    "labels_and_features",
    """
    SELECT o_orderkey, o_totalprice, n_lines, qty FROM orders LEFT JOIN (
      SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) f ON o_orderkey = l_orderkey""",
)
def labels_and_features(spark, folder):
    features = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")
    )
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").join(features, "o_orderkey", "left")


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders) t WHERE rn = 1""",
)
def latest_order(spark, folder):
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


_COSINE = "list_dot_product(e, q) / (SQRT(list_dot_product(e, e)) * SQRT(list_dot_product(q, q)))"


@query(
    "vector_topk",
    f"""
    WITH x AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    m AS (SELECT label, i, AVG(e[i]) AS v FROM x, (SELECT UNNEST(generate_series(1, 64)) AS i) g GROUP BY label, i),
    c AS (SELECT label AS query_label, list(v ORDER BY i) AS q FROM m GROUP BY label),
    s AS (SELECT query_label, vec_id, ROUND({_COSINE}, 6) AS similarity FROM x CROSS JOIN c),
    t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_label ORDER BY similarity DESC, vec_id) AS rank FROM s)
    SELECT query_label, rank, vec_id, similarity FROM t WHERE rank <= 5""",
)
def vector_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    centers = mean_vectors(vectors, ["label"], "embedding").withColumnRenamed("label", "query_label")
    best = vector_top_k(vectors, centers, "query_label", "centroid", "vec_id", "embedding", 5, digits=6)
    return best.withColumn("rank", F.col("rank").cast("long"))


_NEAREST_SQL = f"""
    x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    c AS (SELECT vec_id AS query, e AS q FROM x WHERE vec_id % 20 = 0),
    s AS (SELECT query, vec_id, ROUND({_COSINE}, 6) AS similarity FROM x CROSS JOIN c),
    t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS rank FROM s)"""


def _asked(vectors):
    """The stated queries: every vector whose id is divisible by 20."""
    return vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("asked"))


@query("vector_neighbours", f"WITH {_NEAREST_SQL} SELECT query, rank, vec_id, similarity FROM t WHERE rank <= 10")
def vector_neighbours(spark, folder):
    vectors = table(spark, folder, "embeddings")
    best = vector_top_k(vectors, _asked(vectors), "query", "asked", "vec_id", "embedding", 10, digits=6)
    return best.withColumn("rank", F.col("rank").cast("long"))


@query("vector_index_recall", f"WITH {_NEAREST_SQL} SELECT COUNT(DISTINCT query) AS queries, COUNT(*) AS pairs, TRUE AS enough FROM t WHERE rank <= 10")
def vector_index_recall(spark, folder):
    """What an index of cells finds of the exact neighbours: nine in ten at least.

    The vectors have no clusters, so two thirds of the cells have to be looked
    into (12 of 32 find three quarters); clustered ones need far fewer.
    """
    vectors = table(spark, folder, "embeddings")
    path = f"{checkpoint_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    build_vector_index(vectors, "vec_id", "embedding", path, cells=32)
    found = index_top_k(path, _asked(vectors), "query", "asked", "vec_id", 10, probes=22, digits=6)
    exact = vector_top_k(vectors, _asked(vectors), "query", "asked", "vec_id", "embedding", 10, digits=6)
    return recall(found, exact, "query", "vec_id").select("queries", "pairs", (F.col("recall") >= 0.9).alias("enough"))
