"""Choosing features, components and models over the star tables, with every score in the result."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from formline.functions.numbers import round_half_up
from formline.plans import models
from formline.plans.star.registry import query, r2, table
from formline.session import checkpoint_dir
from formline.sources.tables import solidify

FEATURES = ["qty", "amount", "n_lines", "discount", "acctbal"]

_ROWS_SQL = """
    l AS (SELECT l_orderkey, SUM(l_quantity) AS qty, SUM(l_extendedprice) AS amount, CAST(COUNT(*) AS DOUBLE) AS n_lines, AVG(l_discount) AS discount FROM lineitem GROUP BY 1),
    x AS (SELECT o_orderkey, o_totalprice AS y, qty, amount, n_lines, discount, CASE WHEN o_custkey % 7 <> 0 THEN c_acctbal END AS acctbal
          FROM orders LEFT JOIN l ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O')"""

_SCORES_SQL = f"""{_ROWS_SQL},
    v AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, y FROM x WHERE {c} IS NOT NULL" for c in FEATURES)}),
    e AS (SELECT feature, quantile_disc(v, {[i / 16 for i in range(1, 16)]}) AS edges FROM v GROUP BY feature),
    b AS (SELECT v.feature, len(list_filter(edges, lambda q: q < v.v)) AS bin, y FROM v JOIN e USING (feature)),
    g AS (SELECT feature, bin, COUNT(*) AS n, SUM(y) AS s, SUM(y * y) AS ss FROM b GROUP BY ALL),
    a AS (SELECT *, SUM(n) OVER (PARTITION BY feature) AS na, SUM(s) OVER (PARTITION BY feature) AS sa,
            SUM(n) OVER w AS nl, SUM(s) OVER w AS sl FROM g WINDOW w AS (PARTITION BY feature ORDER BY bin)),
    t AS (SELECT COUNT(*) * VAR_POP(y) AS total FROM x),
    scores AS (SELECT feature, ROUND(COALESCE(MAX(CASE WHEN nl < na THEN sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na END), 0) / ANY_VALUE(total), 6) AS score FROM a, t GROUP BY feature),
    placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY feature <> 'discount', score DESC, feature) AS place FROM scores)"""


def played_orders(spark, folder):
    """Played orders with five features of their lines and customer; balances are missing for a seventh of the customers."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("amount"), F.count(F.lit(1)).cast("double").alias("n_lines"), F.avg("l_discount").alias("discount")
    )
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("acctbal"))
    orders = table(spark, folder, "orders").filter("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("y"))
    return orders.join(lines, "o_orderkey", "left").join(customer, "o_custkey", "left").select("o_orderkey", "y", *FEATURES)


def training_rows(spark, folder):
    """The played orders as a table."""
    return solidify(played_orders(spark, folder), f"{_root(spark)}/rows")


def _root(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/training-{uuid.uuid4().hex}"


@query("ml_feature_select", f"WITH {_SCORES_SQL} SELECT feature, score, CAST(place AS INT) AS place, place <= 3 AS chosen FROM placed")
def ml_feature_select(spark, folder):
    """The three strongest features of the order value, the discount kept in any case."""
    return models.rank_features(training_rows(spark, folder), "y", FEATURES, 3, must_have=["discount"], bins=16)


@query(
    "feature_tables",
    f"""WITH {_SCORES_SQL}
    SELECT w AS width, o_orderkey, {r2("COALESCE(SUM(v), 0)")} AS total, COUNT(v) AS known
    FROM (SELECT 1 AS w UNION ALL SELECT 3 UNION ALL SELECT 5), (
      {" UNION ALL ".join(f"SELECT o_orderkey, '{c}' AS feature, {c} AS v FROM x" for c in FEATURES)}) u JOIN placed USING (feature)
    WHERE place <= w GROUP BY ALL""",
)
def feature_tables(spark, folder):
    """Tables of the best 1, 3 and 5 features, written in one pass, half of the
    rows first and then all, and read back."""
    rows, root = training_rows(spark, folder), _root(spark)
    ranked = models.rank_features(rows, "y", FEATURES, 3, must_have=["discount"], bins=16)
    models.write_ranked_tables(rows.filter("o_orderkey % 2 = 0"), ranked, ["o_orderkey"], f"{root}/first", [1, 3, 5])
    models.write_ranked_tables(rows, ranked, ["o_orderkey"], f"{root}/second", [1, 3, 5], current=f"{root}/first")
    total = F.aggregate(F.map_values("features"), F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    known = F.size(F.filter(F.map_values("features"), lambda v: v.isNotNull())).cast("long")
    parts = [models.read_ranked_table(spark, f"{root}/second", w).select(F.lit(w).alias("width"), "o_orderkey", round_half_up(total).alias("total"), known.alias("known")) for w in (1, 3, 5)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TRIPLE_SQL = f"""{_ROWS_SQL},
    c AS (SELECT CORR(y, qty) AS a, CORR(y, amount) AS b, CORR(qty, amount) AS d FROM x),
    p AS (SELECT a * a + b * b + d * d AS p1, a * b * d AS abd FROM c),
    e AS (SELECT SQRT(p1 / 3) AS p, ACOS(GREATEST(-1, LEAST(1, abd / POWER(p1 / 3, 1.5)))) / 3 AS phi FROM p),
    v AS (SELECT 1 AS component, (1 + 2 * p * COS(phi)) / 3 AS share FROM e UNION ALL SELECT 2, (1 + 2 * p * COS(phi + 4 * PI() / 3)) / 3 FROM e UNION ALL SELECT 3, (1 + 2 * p * COS(phi + 2 * PI() / 3)) / 3 FROM e)"""


@query(
    "pca_shares",
    f"""WITH {_TRIPLE_SQL}
    SELECT CAST(component AS INT) AS component, ROUND(share, 6) AS share, ROUND(SUM(share) OVER (ORDER BY component), 6) AS so_far,
           SUM(share) OVER (ORDER BY component) - share < 0.9 AS kept FROM v""",
)
def pca_shares(spark, folder):
    """What each principal component of three standardized columns explains, and which are kept for nine tenths."""
    shares = models.explained_shares(training_rows(spark, folder), ["y", "qty", "amount"], 0.9)
    return shares.select("component", F.round("share", 6).alias("share"), F.round("so_far", 6).alias("so_far"), "kept")


_FOLD = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7) AS BIGINT) % 100"
_LINES = ["qty", "amount", "n_lines"]
_SEARCH_SQL = f"""{_ROWS_SQL},
    f AS (SELECT *, CASE WHEN {_FOLD} < 33 THEN 'f0' WHEN {_FOLD} < 66 THEN 'f1' ELSE 'f2' END AS fold FROM x),
    k AS (SELECT DISTINCT fold FROM f),
    u AS ({" UNION ALL ".join(f"SELECT 'line on {c}' AS candidate, o_orderkey, fold, y, {c} AS v FROM f" for c in _LINES)}),
    g AS (SELECT candidate, k.fold, AVG(v) AS mean FROM k JOIN u ON u.fold <> k.fold GROUP BY ALL),
    m AS (SELECT g.candidate, g.fold, regr_slope(y, COALESCE(v, mean)) AS b, regr_intercept(y, COALESCE(v, mean)) AS i
          FROM g JOIN u ON u.candidate = g.candidate AND u.fold <> g.fold GROUP BY ALL),
    o AS (SELECT u.candidate, y, b * COALESCE(v, mean) + i AS p FROM u JOIN g ON u.candidate = g.candidate AND u.fold = g.fold JOIN m ON m.candidate = g.candidate AND m.fold = g.fold),
    errors AS (SELECT candidate, COUNT(*) AS n, SQRT(AVG((y - p) * (y - p))) AS rmse FROM o GROUP BY candidate)"""


def _lines() -> dict:
    return {
        f"line on {c}": Pipeline(stages=[*models.feature_stages([c]), LinearRegression(featuresCol="features", labelCol="y", solver="normal")]) for c in _LINES
    }


@query("ml_search", f"WITH {_SEARCH_SQL} SELECT candidate, n, {r2('rmse', 4)} AS rmse, ROW_NUMBER() OVER (ORDER BY rmse, candidate) = 1 AS best FROM errors")
def ml_search(spark, folder):
    """Lines on three columns, compared by their errors on three folds of orders that they weren't fitted on."""
    predictions = models.cross_predictions(played_orders(spark, folder), "y", ["o_orderkey"], _lines(), f"{_root(spark)}/predictions")
    errors = models.candidate_errors(predictions)
    return errors.select("candidate", "n", round_half_up("rmse", 4).alias("rmse"), "best")


@query(
    "ml_refit",
    f"""WITH {_SEARCH_SQL}, w AS (SELECT candidate FROM errors ORDER BY rmse, candidate LIMIT 1),
    h AS (SELECT candidate, AVG(v) AS mean FROM u GROUP BY candidate),
    r AS (SELECT candidate, ANY_VALUE(mean) AS mean, regr_slope(y, COALESCE(v, mean)) AS b, regr_intercept(y, COALESCE(v, mean)) AS i FROM u JOIN h USING (candidate) GROUP BY candidate)
    SELECT o_orderkey, candidate, {r2("b * COALESCE(v, mean) + i")} AS predicted, TRUE AS same FROM u JOIN w USING (candidate) JOIN r USING (candidate)""",
)
def ml_refit(spark, folder):
    """The best candidate fitted on all rows, written, read again and applied: the kept model predicts what the fitted one does."""
    root = _root(spark)
    rows = models.deal_rows(played_orders(spark, folder), ["o_orderkey"], f"{root}/rows")
    predictions = models.cross_predictions(rows, "y", ["o_orderkey"], _lines(), f"{root}/predictions", dealt=True)
    name = models.candidate_errors(predictions).filter("best").first().candidate
    model = models.refit_and_keep(_lines()[name], rows, f"{root}/model")
    kept = models.score(models.load_kept(f"{root}/model"), rows, keep=["o_orderkey"])
    both = models.score(model, rows, "before", keep=["o_orderkey"]).join(kept, "o_orderkey")
    return both.select("o_orderkey", F.lit(name).alias("candidate"), round_half_up("predicted").alias("predicted"), (F.col("before") == F.col("predicted")).alias("same"))


@query(
    "columns_by_kind",
    """SELECT column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'categorical' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'numeric' END AS kind
    FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_totalprice > 1000 AS large FROM orders) d WHERE column_name <> 'o_orderkey'""",
)
def columns_by_kind(spark, folder):
    """Usable columns of the orders by kind, without the key and the date."""
    orders = table(spark, folder, "orders").withColumn("large", F.col("o_totalprice") > 1000)
    kinds = models.split_columns(orders, deny=["o_orderkey"])
    return spark.createDataFrame([(c, kind) for kind, some in kinds.items() for c in some], "name string, kind string")
