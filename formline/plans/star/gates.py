"""Files, gates, feeds, SQL functions and the form table over the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from formline.functions import sqlfunctions
from formline.functions.numbers import round_half_up
from formline.operators import quality
from formline.operators.rolling import player_form
from formline.operators.shape import union_by_position
from formline.plans import models, reports
from formline.plans.star.registry import GAMES_SQL, dated_orders, nation_pairs, query, r2, table
from formline.plans.star.served import PREDICTION_SQL, predictions
from formline.session import checkpoint_dir
from formline.sources import feeds, tables


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("csv_with_stray_headers", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def csv_with_stray_headers(spark, folder):
    """Written as CSV with a header line among the rows and every third row
    twice, read back keyed."""
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority")
    stray = spark.range(1).select(F.lit("o_orderkey").alias("o_orderkey"), F.lit("o_orderpriority").alias("o_orderpriority"))
    path = _folder(spark, "csv")
    rows.unionByName(rows.filter("o_orderkey % 3 = 0")).unionByName(stray).write.option("header", True).csv(path)
    return tables.read_csv_table(spark, path, keys=["o_orderkey"], stray_header="o_orderkey")


@query(
    "overwrite_merged_schema",
    "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0",
)
def overwrite_merged_schema(spark, folder):
    """A table replaced by rows of another shape keeps the old column."""
    customers, path = table(spark, folder, "customer"), _folder(spark, "merged")
    tables.overwrite(customers.select("c_custkey", "c_mktsegment"), path)
    tables.overwrite(customers.filter("c_acctbal > 0").select("c_custkey", "c_acctbal"), path, merge_schema=True)
    return tables.read_table(spark, path)


@query(
    "feature_table_merge",
    "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE c_acctbal + 1 END AS v FROM customer",
)
def feature_table_merge(spark, folder):
    """Created with two thirds of the rows (c_custkey % 3 < 2), then merged with
    the two thirds above 0 at new values."""
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").alias("v"))
    first, second = _folder(spark, "features"), _folder(spark, "features")
    tables.create_or_merge(spark, customers.filter("c_custkey % 3 < 2"), None, first, ["c_custkey"])
    newer = customers.filter("c_custkey % 3 > 0").withColumn("v", F.col("v") + 1)
    return tables.create_or_merge(spark, newer, first, second, ["c_custkey"])


@query(
    "export_and_backup",
    """SELECT 'customer' AS "table", COUNT(*) AS original, COUNT(*) AS copied, 'OK' AS status FROM customer
    UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 'OK' FROM orders""",
)
def export_and_backup(spark, folder):
    """Keyed serving copies, and a backup of them with both counts."""
    copies = {}
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")):
        copies[name] = _folder(spark, name)
        tables.export_keyed(table(spark, folder, name), copies[name], [key])
    return tables.backup(spark, copies, _folder(spark, "backup"))


@query("row_checkpoints", "SELECT COUNT(*) AS n_rows, CAST(MAX(o_totalprice) AS DOUBLE) AS top FROM orders WHERE o_orderstatus <> 'O'")
def row_checkpoints(spark, folder):
    """Counts observed while a table is written anyway."""
    played = table(spark, folder, "orders").filter("o_orderstatus <> 'O'")
    watched, watch = quality.counted(played, f"played-{uuid.uuid4().hex}", top=F.max("o_totalprice"))
    tables.overwrite(watched, _folder(spark, "played"))
    seen = watch.get if isinstance(watch, Observation) else watch
    return spark.createDataFrame([(seen["rows"], seen["top"])], "n_rows long, top double")


def _passes(check) -> bool:
    try:
        check()
    except (quality.QualityError, ValueError):
        return False
    return True


@query(
    "gate_verdicts",
    """
    SELECT 'order keys unique' AS gate, COUNT(*) = COUNT(DISTINCT o_orderkey) AS passed FROM orders
    UNION ALL SELECT 'line orders unique', COUNT(*) = COUNT(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'prices in range', MIN(o_totalprice) > 0 AND MAX(o_totalprice) < 1e9 FROM orders
    UNION ALL SELECT 'mean price below 1', AVG(o_totalprice) < 1 FROM orders
    UNION ALL SELECT 'customers joined uniquely', (SELECT COUNT(*) = COUNT(DISTINCT c_custkey) FROM customer)
    UNION ALL SELECT 'orders meet customers', EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey)
    UNION ALL SELECT 'negative keys meet', EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = -1 - c_custkey)
    UNION ALL SELECT 'order contract', TRUE UNION ALL SELECT 'order contract with a wrong type', FALSE
    UNION ALL SELECT 'halves of orders agree', TRUE UNION ALL SELECT 'orders agree with customers', FALSE""",
)
def gate_verdicts(spark, folder):
    orders, customers, lines = (table(spark, folder, n) for n in ("orders", "customer", "lineitem"))
    summary = orders.agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.avg("o_totalprice").alias("mean"))
    shifted = customers.select((-1 - F.col("c_custkey")).alias("o_custkey"))
    named = customers.withColumnRenamed("c_custkey", "o_custkey")
    contract = {"o_orderkey": "bigint", "o_totalprice": "double"}

    def agreed(problems):
        if problems:
            raise quality.QualityError(str(problems))

    checks = {
        "order keys unique": lambda: quality.assert_unique(orders, ["o_orderkey"], allow_null=False),
        "line orders unique": lambda: quality.assert_unique(lines, ["l_orderkey"]),
        "prices in range": lambda: quality.expect_or_fail(summary, {"low": "low > 0", "high": "high < 1e9"}),
        "mean price below 1": lambda: quality.expect_or_fail(summary, {"mean": "mean < 1"}),
        "customers joined uniquely": lambda: quality.join_unique(orders, named, ["o_custkey"]),
        "orders meet customers": lambda: quality.join_not_empty(orders, named, ["o_custkey"]),
        "negative keys meet": lambda: quality.join_not_empty(orders, shifted, ["o_custkey"]),
        "order contract": lambda: agreed(quality.schema_problems(orders, contract, ["password"])),
        "order contract with a wrong type": lambda: agreed(quality.schema_problems(orders, {"o_orderkey": "string"})),
        "halves of orders agree": lambda: quality.assert_same_schema(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1")),
        "orders agree with customers": lambda: quality.assert_same_schema(orders, customers),
    }
    return spark.createDataFrame([(name, _passes(check)) for name, check in checks.items()], "gate string, passed boolean")


@query(
    "usage_filters",
    """
    WITH u AS (SELECT o_orderkey, o_orderstatus, COUNT(*) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS used FROM orders)
    SELECT o_orderkey, 'train' AS kind FROM u WHERE o_orderstatus <> 'O' AND used > 5 UNION ALL SELECT o_orderkey, 'score' FROM u WHERE o_orderstatus = 'O' AND used > 3""",
)
def usage_filters(spark, folder):
    from formline.operators.rolling import games_played

    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    used = games_played(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", "used", bounded_by=[orders])
    rows = used.withColumn("game", F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")))
    train = models.trainable(rows, "game", "used", 5).select("o_orderkey", F.lit("train").alias("kind"))
    return train.unionByName(models.scorable(rows, "game", "used", 3).select("o_orderkey", F.lit("score").alias("kind")))


@query(
    "union_by_position",
    "SELECT c_custkey AS k, c_name AS v FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def positions(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return union_by_position(customers, table(spark, folder, "supplier").select("s_suppkey", "s_name"))


def _fan_sql(keys, name, measure, prefix):
    w = f"PARTITION BY {keys} ORDER BY d, k"
    parts = [f"COALESCE({r2(f'LAST_VALUE({measure} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')}, 0) AS {prefix}previous_{name}"]
    for n in (3, 7):
        parts.append(f"COALESCE({r2(f'AVG({measure}) OVER ({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)')}, 0) AS {prefix}average_{name}_last_{n}_games")
    return parts


_FAN = [
    p for keys, prefix in (("o_custkey", ""), ("o_custkey, o_orderpriority", "matchup_")) for m in ("price", "qty", "n_lines") for p in _fan_sql(keys, m, m, prefix)
]


@query(
    "player_form_fanout",
    f"""
    WITH l AS (SELECT l_orderkey, SUM(l_quantity) AS qty, COUNT(*) AS n_lines FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey AS k, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, qty, n_lines FROM orders LEFT JOIN l ON o_orderkey = l_orderkey)
    SELECT k, {", ".join(_FAN)} FROM r""",
)
def player_form_fanout(spark, folder):
    """Previous value and two means of every measure, per customer and per customer and priority."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines")
    )
    orders = dated_orders(spark, folder, "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    rows = orders.select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderpriority", F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("price")
    ).join(lines, "k", "left")
    formed = player_form(
        rows, ["o_custkey"], ["o_custkey", "o_orderpriority"], ["d", "k"], ["price", "qty", "n_lines"], F.lit(True), bounded_by=[orders]
    )
    return formed.drop("o_custkey", "o_orderpriority", "d", "price", "qty", "n_lines")


@query(
    "predictions_explained",
    f"""
    WITH {PREDICTION_SQL},
    x AS (SELECT DISTINCT "shooterName", "gameDate", "playerTeam", "opposingTeam" FROM pr WHERE "gameId" IS NULL)
    SELECT pr."order", pr."playerId", CASE WHEN x."shooterName" IS NOT NULL AND pr."playerTeam" % 2 = 0 THEN 'team ' || pr."playerTeam" || ' meets ' || pr."opposingTeam" END AS explanation
    FROM pr LEFT JOIN x ON pr."shooterName" = x."shooterName" AND pr."gameDate" = x."gameDate" AND pr."playerTeam" = x."playerTeam" AND pr."opposingTeam" = x."opposingTeam" WHERE "gameId" IS NULL""",
)
def predictions_explained(spark, folder):
    """Every team has a row of texts; those of odd number are null."""
    rows = predictions(spark, folder)
    keys = ["shooterName", "gameDate", "playerTeam", "opposingTeam"]
    texts = rows.filter("gameId is null").select(*keys).distinct()
    texts = texts.withColumn("Explanation", F.when(F.col("playerTeam") % 2 == 0, F.concat(F.lit("team "), F.col("playerTeam").cast("string"), F.lit(" meets "), F.col("opposingTeam").cast("string"))))
    shown = reports.predictions_view(rows, texts, reports.prediction_filter(), tie=("playerId", "order"))
    return shown.select("order", "playerId", F.col("Explanation").alias("explanation"))


@query(
    "sql_scalar_functions",
    f"""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M''s' ELSE 'other' END AS code,
      {r2("(c_acctbal + c_acctbal * 0.25) * (c_custkey % 5)")} AS total FROM customer""",
)
def sql_scalar_functions(spark, folder):
    sqlfunctions.register_code_lookup(spark, "segment_code", {"BUILDING": "B", "MACHINERY": "M's"}, "other")
    sqlfunctions.register_total_price(spark, "total_price")
    table(spark, folder, "customer").createOrReplaceTempView("gate_customers")
    found = spark.sql(
        "SELECT c_custkey, segment_code(c_mktsegment) AS code, total_price(c_acctbal, 0.25D, CAST(c_custkey % 5 AS INT)) AS total FROM gate_customers"
    )
    return found.withColumn("total", round_half_up("total"))


@query(
    "sql_table_functions",
    """
    WITH k AS (SELECT MAX(o_custkey) AS c FROM orders)
    SELECT 'newest' AS kind, o_orderkey FROM (SELECT o_orderkey FROM orders, k WHERE o_custkey = c ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 4) a
    UNION ALL SELECT 'sample', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25) b""",
)
def sql_table_functions(spark, folder):
    """The newest four orders of one customer, and the 25 cheapest of all."""
    table(spark, folder, "orders").createOrReplaceTempView("gate_orders")
    sqlfunctions.register_latest_rows(spark, "latest_orders", "gate_orders", "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"], played="o_orderstatus")
    sqlfunctions.register_sample(spark, "cheapest_orders", "gate_orders", ["o_orderkey"], ["o_totalprice", "o_orderkey"])
    return spark.sql(
        "SELECT 'newest' AS kind, o_orderkey FROM latest_orders((SELECT max(o_custkey) FROM gate_orders), 4)"
        " UNION ALL SELECT 'sample', o_orderkey FROM cheapest_orders()"
    )


@query(
    "feed_events",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS game_id,
      CAST(ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) - 1 AS INTEGER) AS event_index,
      CASE event_type WHEN 'click' THEN 'shot-on-goal' WHEN 'view' THEN 'missed-shot' ELSE event_type END AS type,
      CAST(1 + event_id % 3 AS INTEGER) AS period, CASE WHEN event_id % 4 = 0 THEN '00:00' ELSE '12:34' END AS clock,
      CASE WHEN event_id % 5 = 0 THEN '1541' WHEN event_id % 5 = 1 THEN '1551' ELSE '1451' END AS code,
      CAST(user_id AS VARCHAR) AS actor, CAST(value AS DOUBLE) AS x
    FROM events""",
)
def feed_events(spark, folder):
    """Events packed as game documents of both shapes and spellings, written
    as JSON lines, read with the feed's schema and made flat again."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    new = F.col("user_id") % 2 == 0
    kind = F.when(F.col("event_type") == "click", F.when(new, "shot-on-goal").otherwise("Shot")).when(
        F.col("event_type") == "view", F.when(new, "Missed Shot").otherwise("missedshot")
    ).otherwise(F.col("event_type"))
    late = F.col("event_id") % 4 == 0
    code = F.when(F.col("event_id") % 5 > 1, "1451")
    strength = F.when(F.col("event_id") % 5 == 0, "702")
    # The document keeps the event's number as y, to tell rows apart afterwards.
    play = F.when(
        new,
        F.struct(
            F.col("event_id").alias("_n"), kind.alias("typeDescKey"), F.when(late, "").otherwise("12:34").alias("timeInPeriod"), code.alias("situationCode"),
            strength.alias("strength"), F.struct((1 + F.col("event_id") % 3).cast("int").alias("number")).alias("periodDescriptor"),
            F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("time"), F.lit(None).cast("int").alias("period"),
            F.lit(None).cast("string").alias("pid1"), F.lit(None).cast("double").alias("xcoord"), F.lit(None).cast("double").alias("ycoord"),
            F.struct(F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("playerId"), F.col("value").alias("xCoord"), F.col("event_id").cast("double").alias("yCoord")).alias("details"),
        ),
    ).otherwise(
        F.struct(
            F.col("event_id").alias("_n"), F.lit("").alias("typeDescKey"), F.lit("").alias("timeInPeriod"), code.alias("situationCode"),
            strength.alias("strength"), F.struct(F.lit(None).cast("int").alias("number")).alias("periodDescriptor"),
            kind.alias("type"), F.when(late, F.lit(None).cast("string")).otherwise("12:34").alias("time"), (1 + F.col("event_id") % 3).cast("int").alias("period"),
            F.col("user_id").cast("string").alias("pid1"), F.col("value").alias("xcoord"), F.col("event_id").cast("double").alias("ycoord"),
            F.struct(F.lit(None).cast("string").alias("playerId"), F.lit(None).cast("double").alias("xCoord"), F.lit(None).cast("double").alias("yCoord")).alias("details"),
        )
    )
    games = events.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(play)).alias("plays")).select(
        F.to_json(
            F.struct(
                F.concat_ws("-", F.col("user_id").cast("string"), F.col("day").cast("string")).alias("game_id"),
                F.when(F.col("user_id") % 3 > 0, F.col("plays")).alias("plays"),
                F.struct(F.struct(F.struct(F.when(F.col("user_id") % 3 == 0, F.col("plays")).alias("play")).alias("plays")).alias("game")).alias("data"),
            )
        ).alias("value")
    )
    path = _folder(spark, "feed")
    games.write.text(path)
    flat = feeds.events_of(feeds.read_games(spark, path))
    return flat.select(F.col("y").cast("long").alias("event_id"), "game_id", "event_index", "type", "period", "clock", "code", F.col("actor_id").alias("actor"), "x")


@query(
    "schedule_feed",
    f"""
    WITH {GAMES_SQL}
    SELECT CAST(game AS VARCHAR) AS id, CAST(d AS VARCHAR) AS d, 'N' || home AS home, 'N' || away AS away, CAST(home_points AS INTEGER) AS home_score
    FROM pairs WHERE game % 4 IN (1, 2) AND status <> 'O'""",
)
def schedule_feed(spark, folder):
    """Games as schedule documents: four kinds of games, of which two count;
    open ones have no score."""
    pairs = nation_pairs(spark, folder)
    over = F.col("status") != "O"

    def side(team, points):
        return F.struct(F.concat(F.lit("N"), F.col(team).cast("string")).alias("abbrev"), F.when(over, F.col(points).cast("int")).alias("score"))

    documents = pairs.select(
        F.to_json(
            F.struct(
                F.col("game").cast("string").alias("id"), (F.col("game") % 4 + 1).cast("int").alias("gameType"), F.col("d").cast("string").alias("gameDate"),
                F.when(over, F.when(F.col("game") % 2 == 0, "OFF").otherwise("FINAL")).otherwise("FUT").alias("gameState"),
                side("home", "home_points").alias("homeTeam"), side("away", "away_points").alias("awayTeam"),
            )
        ).alias("value")
    )
    path = _folder(spark, "schedule")
    documents.write.text(path)
    rows = feeds.read_schedule(spark, path, finished_only=True)
    return rows.select(
        F.col("GAME_ID").alias("id"), F.col("DATE").cast("string").alias("d"), F.col("HOME").alias("home"), F.col("AWAY").alias("away"), "home_score"
    )


@query(
    "feed_rosters",
    """
    WITH m AS (SELECT DISTINCT l_orderkey AS g, l_partkey AS p, l_linenumber <= 4 AS is_home FROM lineitem)
    SELECT CAST(g AS VARCHAR) AS game_id, CAST(p AS VARCHAR) AS player_id, is_home, CASE WHEN is_home THEN 'H' ELSE 'A' END AS team, CASE WHEN is_home THEN 'A' ELSE 'H' END AS opponent,
      CASE WHEN p % 5 = 0 THEN NULL WHEN p % 4 = 0 THEN 'number ' || p ELSE p_brand || ' ' || p_name END AS name
    FROM m JOIN part ON p = p_partkey""",
)
def feed_rosters(spark, folder):
    """Orders as game documents whose line-ups are the parts of their lines,
    named in three ways or not at all, written as JSON lines and read with the
    feed's schema. Ids are written as decimals here and there."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key, number = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    member = F.struct(F.when(number % 2 == 0, F.concat(key, F.lit(".0"))).otherwise(key).alias("playerId"))
    plain = F.col("l_partkey") % 4 == 0

    def named(text):
        return F.struct(F.when(~plain, text).alias("default"))

    spot = F.struct(
        key.alias("playerId"), named(F.concat(F.col("p_brand"), F.lit(" "))).alias("firstName"), named(F.col("p_name")).alias("lastName"),
        F.when(plain, F.concat(F.lit("number "), key)).alias("name"),
    )

    def those(condition):
        return F.collect_list(F.when(condition, member))

    packed = lines.groupBy("l_orderkey").agg(
        those(number <= 2).alias("hf"), those((number > 2) & (number <= 4)).alias("hd"), those(number > 4).alias("af"),
        F.collect_list(F.when(F.col("l_partkey") % 5 > 0, spot)).alias("spots"),
    )
    home = F.struct(F.lit("H").alias("abbrev"), F.col("hf").alias("forwards"), F.col("hd").alias("defense"))
    away = F.struct(F.lit("A").alias("abbrev"), F.col("af").alias("forwards"))
    path = _folder(spark, "rosters")
    packed.select(F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("game_id"), home.alias("home"), away.alias("away"), F.col("spots").alias("rosterSpots"))).alias("value")).write.text(path)
    return feeds.rosters_of(feeds.read_games(spark, path))
