"""Incremental loads over the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from formline.operators.streaks import newest_rows
from formline.plans.star.registry import dated_orders, query, table, text
from formline.sources.incremental import (
    date_spine,
    dedupe_keep_lowest,
    fetch_window,
    new_rows_only,
    priority_merge,
    refresh,
    snapshot_diff,
    upsert,
    upsert_keeping,
)
from formline.session import checkpoint_dir
from formline.sources.tables import first_non_empty, solidify_by

# Orders up to the cutoff are "stored"; a load brings everything from a year
# before the cutoff on, with changed prices, so both overlap.
STORED = "o_orderdate <= DATE '2000-01-01'"
LOADED = "o_orderdate > DATE '1999-01-01'"
CHANGED = "o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"
MAYBE = f"CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {CHANGED} END"


def _stored(spark, folder):
    return dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_totalprice", last="2000-01-01")


def _loaded(spark, folder, price=CHANGED):
    loaded = dated_orders(spark, folder, first="1999-01-02")
    return loaded.select("o_orderkey", "o_custkey", F.expr(price).alias("o_totalprice"))


@query(
    "anti_join_append",
    f"""SELECT o_orderkey, o_custkey, {CHANGED} AS o_totalprice FROM orders WHERE {LOADED} AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {STORED})""",
)
def anti_join_append(spark, folder):
    return new_rows_only(_loaded(spark, folder), _stored(spark, folder), ["o_orderkey"], ["o_totalprice"])


@query(
    "upsert_keyed",
    f"""
    SELECT o_orderkey, o_custkey, {CHANGED} AS o_totalprice FROM orders WHERE {LOADED}
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE NOT ({LOADED})""",
)
def upsert_keyed(spark, folder):
    return upsert(_stored(spark, folder), _loaded(spark, folder), ["o_orderkey"])


@query(
    "upsert_keeping_old",
    f"""
    SELECT o_orderkey, o_custkey, CASE WHEN {LOADED} AND {STORED} THEN COALESCE({MAYBE}, o_totalprice) WHEN {LOADED} THEN {MAYBE} ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def upsert_keeping_old(spark, folder):
    return upsert_keeping(_stored(spark, folder), _loaded(spark, folder, MAYBE), ["o_orderkey"])


@query(
    "priority_merge",
    f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {STORED}
    UNION ALL SELECT o_orderkey, o_custkey, {CHANGED} FROM orders WHERE NOT ({STORED})""",
)
def merge_by_priority(spark, folder):
    return priority_merge([_stored(spark, folder), _loaded(spark, folder)], ["o_orderkey"])


@query(
    "refresh_union",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {LOADED} THEN {CHANGED} ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def refresh_union(spark, folder):
    return refresh(_stored(spark, folder), _loaded(spark, folder), ["o_orderkey"], [F.desc("o_totalprice")])


@query(
    "snapshot_diff",
    f"""
    SELECT o_orderkey, CASE WHEN NOT ({STORED}) THEN 'insert' WHEN NOT ({LOADED}) THEN 'delete' ELSE 'update' END AS change
    FROM orders WHERE NOT ({STORED} AND {LOADED} AND {CHANGED} = o_totalprice)""",
)
def diff(spark, folder):
    return snapshot_diff(_stored(spark, folder), _loaded(spark, folder), ["o_orderkey"])


@query(
    "incremental_window",
    """
    SELECT CAST(CAST(LEAST(MAX(CAST(ts AS DATE)) - INTERVAL 3 DAY, DATE '2024-02-01' - INTERVAL 1 DAY) AS DATE) AS VARCHAR) AS start_date, '2024-02-01' AS end_date FROM events""",
)
def incremental_window(spark, folder):
    events = table(spark, folder, "events")
    window = fetch_window(events, "ts", F.lit("2024-02-01").cast("date"), 3, "2023-10-01")
    return window.select(text("start_date"), text("end_date"))


@query(
    "date_spine",
    """
    SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day FROM (
      SELECT UNNEST(generate_series(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS day FROM orders) t""",
)
def spine(spark, folder):
    bounds = dated_orders(spark, folder, "o_orderdate").agg(
        F.min("o_orderdate").alias("start_date"), F.max("o_orderdate").alias("end_date")
    )
    return date_spine(bounds).select(text("day"))


@query(
    "ordered_dedupe",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) t WHERE rn = 1""",
)
def ordered_dedupe(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    best = newest_rows(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_quantity"), F.desc("l_extendedprice")], 1)
    return best.drop("_rn")


@query("dedupe_keep_lowest", "SELECT o_custkey, o_orderpriority, MIN(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderpriority")
def keep_lowest(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return dedupe_keep_lowest(orders, ["o_custkey", "o_orderpriority"], "o_orderkey")


@query("first_non_empty", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def fallback_source(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return first_non_empty(orders.filter("o_orderstatus = 'X'"), orders.filter("o_orderstatus = 'F'")).drop("o_orderstatus")


@query(
    "solid_by_customer",
    f"""
    SELECT o_orderkey, o_custkey, c_mktsegment, LAG(o_totalprice) OVER w AS previous, CAST(ROW_NUMBER() OVER w AS INT) AS place, COUNT(*) OVER (PARTITION BY o_custkey) AS n
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)""",
)
def solid_by_customer(spark, folder):
    """Orders and customers solidified by the customer: form, rank, count and join of the two need no shuffle any more."""
    root, name = f"{checkpoint_dir(spark).rstrip('/')}/solid-{uuid.uuid4().hex}", f"solid_{uuid.uuid4().hex}"
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    facts = solidify_by(orders, f"{name}_orders", f"{root}/orders", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=8)
    entities = solidify_by(customers, f"{name}_customers", f"{root}/customers", ["o_custkey"], buckets=8)
    of = Window.partitionBy("o_custkey")
    line = of.orderBy("o_orderdate", "o_orderkey")
    formed = facts.withColumns({"previous": F.lag("o_totalprice").over(line), "place": F.row_number().over(line), "n": F.count(F.lit(1)).over(of)})
    return formed.join(entities, "o_custkey", "left").select("o_orderkey", "o_custkey", "c_mktsegment", "previous", "place", "n")
