"""Column helpers against hand-computed values."""

from conftest import rows_of
from pyspark.sql import functions as F

from formline.functions.dates import day_label, day_number, local_date, parse_date, season_by_boundaries, season_code
from formline.functions.numbers import at_least, gap, is_count_name, ratio, round_half_up
from formline.functions.play import clock_seconds, game_seconds, shot_danger, situation
from formline.functions.sqlfunctions import register_code_lookup, register_latest_rows, register_sample, register_total_price
from formline.functions.text import clean_id, collapse_spaces, composite_id, lookup_code, prompt_text, with_comments


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_danger(spark):
    cases = [
        (79.0, 0.0, "high"),
        (60.0, 10.0, "medium"),
        (80.0, 10.0, "medium"),
        (85.0, 10.0, "low"),
        (40.0, 0.0, "low"),
        (89.0, 20.0, "medium"),
        (None, 3.0, "medium"),
    ]
    df = spark.createDataFrame(cases, "x double, y double, want string")
    assert df.filter(shot_danger("x", "y") != F.col("want")).count() == 0


def test_situation_by_side(spark):
    cases = [("1551", "5on5", "5on5"), ("1451", "5on4", "4on5"), ("1541", "4on5", "5on4"), ("1441", "5on5", "5on5"), ("", "5on5", "5on5"), ("abcd", "5on5", "5on5")]
    df = spark.createDataFrame(cases, "c string, home string, away string")
    assert df.filter(situation("c", F.lit(True)) != F.col("home")).count() == 0
    assert df.filter(situation("c", F.lit(False)) != F.col("away")).count() == 0


def test_clock(spark):
    cases = [("01:30", 90), ("12:45", 765), ("", 0), (None, 0), ("x:y", 0), ("7", 0)]
    df = spark.createDataFrame(cases, "c string, want int")
    assert df.filter(clock_seconds("c") != F.col("want")).count() == 0
    assert _one(spark, game_seconds(F.lit(2), F.lit("05:00"))) == 1200 + 900
    assert _one(spark, game_seconds(F.lit(4), F.lit("05:00"))) == 3600
    assert _one(spark, game_seconds(F.lit(0), F.lit("05:00"))) == 0


def test_dates(spark):
    cases = [("20240105", "2024-01-05"), ("2024-01-05", "2024-01-05"), ("soon", None), (None, None)]
    df = spark.createDataFrame(cases, "s string, want string")
    assert df.filter(~parse_date("s").cast("string").eqNullSafe(F.col("want"))).count() == 0
    assert str(_one(spark, parse_date(F.lit(20240105)))) == "2024-01-05"
    slashed = ("M/d/yy", "M/d/yyyy")
    assert str(_one(spark, parse_date(F.lit("1/5/24"), slashed))) == "2024-01-05"
    assert str(_one(spark, parse_date(F.lit("10/25/2024"), slashed))) == "2024-10-25"
    day = F.lit("2024-01-05").cast("date")
    assert _one(spark, day_label(day)) == "Fri."
    assert _one(spark, day_number(day)) == 5
    assert _one(spark, season_code(day)) == 20232024
    assert _one(spark, season_code(F.lit("2024-10-05").cast("date"))) == 20242025
    starts = {"2024-10-01": 20242025, "2025-10-01": 20252026}
    assert _one(spark, season_by_boundaries(day, starts, 20232024)) == 20232024
    assert _one(spark, season_by_boundaries(F.lit("2025-12-01").cast("date"), starts)) == 20252026
    assert str(_one(spark, local_date(F.lit("2024-01-05 03:00:00").cast("timestamp")))) == "2024-01-04"


def test_numbers(spark):
    assert _one(spark, round_half_up(F.lit(0.125))) == 0.13
    assert _one(spark, round_half_up(F.lit(2e13))) == 2e13
    assert _one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert _one(spark, ratio(F.lit(2), F.lit(3))) == 0.67
    assert _one(spark, at_least(F.lit(None).cast("int"), 2)) is None
    assert _one(spark, at_least(F.lit(2), 2)) == 1
    assert _one(spark, gap(F.lit(1.0), F.lit(3.5))) == 2.5
    assert is_count_name("goals") and not is_count_name("iceTimeRank") and not is_count_name("corsiPercentage")


def test_text(spark):
    assert _one(spark, clean_id(F.lit("8471214.0"))) == "8471214"
    assert _one(spark, collapse_spaces(F.lit("  a \n b\t c "))) == "a b c"
    assert _one(spark, composite_id(F.lit(2023), F.lit("7"))) == "202307"
    assert _one(spark, lookup_code(F.lit("Boston"), {"Boston": "BOS"})) == "BOS"
    assert _one(spark, lookup_code(F.lit("Paris"), {"Boston": "BOS"})) == "Unknown"
    df = with_comments(spark.createDataFrame([(1, "x")], "a int, b string"), {"a": "first"})
    assert prompt_text(df, "Do.").first()["prompt"] == 'Do.\na: first\nb:\n{"a":1,"b":"x"}'


def test_sql_functions(spark):
    register_code_lookup(spark, "city_code", {"Boston": "BOS", "St. John's": "SJS"})
    register_total_price(spark)
    row = spark.sql("SELECT city_code('Boston') a, city_code('St. John\\'s') b, city_code('X') c, total_price(100, 0.1, 3) d").first()
    assert (row.a, row.b, row.c) == ("BOS", "SJS", "Unknown")
    assert abs(row.d - 330) < 1e-9
    games = [("A", d, d if d < 6 else None, d * 10) for d in range(1, 7)] + [("B", 1, 1, 5)]
    spark.createDataFrame(games, "name string, day int, game int, shots int").createOrReplaceTempView("game_rows")
    register_latest_rows(spark, "latest_stats", "game_rows", "name", ["day"], ["day", "shots"], played="game")
    assert rows_of(spark.sql("SELECT * FROM latest_stats('A', 2)")) == [(4, 40), (5, 50)]
    assert spark.sql("SELECT * FROM latest_stats('A')").count() == 3
    register_sample(spark, "some_rows", "game_rows", ["name", "day"], ["name", "day"], 4)
    assert spark.sql("SELECT * FROM some_rows()").count() == 4


def test_day_ranges_reach_the_scan(spark, tmp_path):
    from formline.functions.dates import day_range

    stamps = [f"2024-01-0{d} 0{d}:30:00" for d in range(1, 8)]
    raw = spark.createDataFrame([(s,) for s in stamps], "s string")
    for kind in ("timestamp", "timestamp_ntz", "date", "string"):
        path = str(tmp_path / kind)
        raw.select(F.col("s").cast(kind).alias("d")).write.parquet(path)
        df = spark.read.parquet(path)
        kept = df.filter(day_range(df, "d", "2024-01-02", "2024-01-04"))
        assert kept.count() == 3
        if kind != "string":
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert "GreaterThanOrEqual(d," in plan and "LessThan" in plan.split("PushedFilters")[1]


def test_rounding_has_one_path(spark):
    rows = spark.createDataFrame([(0.125,), (2.5e12 + 0.125,), (-1.0e15 - 0.375,), (None,)], "v double")
    got = [r[0] for r in rows.select(round_half_up("v")).collect()]
    assert got == [0.13, 2500000000000.13, -1000000000000000.38, None]


def test_vector_search_in_blocks(spark, monkeypatch):
    from formline.operators import vectors

    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(8)], "i int, v array<double>")
    asked = spark.createDataFrame([(q, [float(q), 2.0]) for q in range(5)], "q int, v array<double>")
    whole = sorted(map(tuple, vectors.vector_top_k(items, asked, "q", "v", "i", "v", 3, digits=6).collect()))
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 2)
    assert sorted(map(tuple, vectors.vector_top_k(items, asked, "q", "v", "i", "v", 3, digits=6).collect())) == whole
    assert len(whole) == 15
    monkeypatch.setattr(vectors, "SENT_BYTES", 40)  # several lanes
    assert sorted(map(tuple, vectors.vector_top_k(items, asked, "q", "v", "i", "v", 3, digits=6).collect())) == whole


def test_vector_search_for_many_queries(spark):
    """5,000 queries: one plan, one scan of the items, rows as by hand."""
    import numpy as np
    from formline.operators import vectors

    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, 8)), rng.normal(size=(5000, 8))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, [0.0] * 8), (901, None), (902, [1.0])], "i int, v array<double>")
    asked = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(y)] + [(None, [1.0] * 8)], "q int, v array<double>")
    best = vectors.vector_top_k(items, asked, "q", "v", "i", "v", 3)
    got = {(r.q, r["rank"]): (r.i, r.similarity) for r in best.collect()}
    near = (y / np.linalg.norm(y, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T
    order = np.argsort(-near, axis=1, kind="stable")[:, :3]
    assert len(got) == 15_000
    assert all(got[q, n + 1][0] == order[q, n] and abs(got[q, n + 1][1] - near[q, order[q, n]]) < 1e-9 for q in range(5000) for n in range(3))
    few = {r.i: r.similarity for r in vectors.vector_top_k(items.filter("i > 297"), asked.filter("q = 0"), "q", "v", "i", "v", 9).collect()}
    assert set(few) == {298, 299, 900, 901, 902} and few[900] is few[901] is few[902] is None


def test_vector_index(spark, tmp_path):
    """All probes give the exact rows, a few most of them; a crowded cell, repeated and missing vectors are indexed as well."""
    import numpy as np
    from formline.operators import vectors

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(400, 6)), np.repeat(rng.normal(size=(1, 6)), 200, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, [0.0] * 6), (901, None), (None, x[0].tolist())]
    items = spark.createDataFrame(rows, "i int, v array<double>").repartition(3)
    asked = items.filter("i % 20 = 0").selectExpr("i AS q", "v AS w")
    path = f"{tmp_path}/index"
    vectors.build_vector_index(items, "i", "v", path, cells=10)
    assert spark.read.parquet(f"{path}/items").selectExpr("sum(size(i_ids))").first()[0] == len(rows)
    exact = vectors.vector_top_k(items, asked, "q", "w", "i", "v", 5, digits=6)
    whole = vectors.index_top_k(path, asked, "q", "w", "i", 5, probes=10, digits=6)
    assert rows_of(whole) == rows_of(exact)
    some = vectors.recall(vectors.index_top_k(path, asked, "q", "w", "i", 5, probes=4, digits=6), exact, "q", "i").first()
    assert some.queries == 31 and 0.8 <= some.recall <= 1
    none = f"{tmp_path}/none"
    vectors.build_vector_index(items.limit(0), "i", "v", none)
    assert vectors.index_top_k(none, asked, "q", "w", "i", 5).collect() == []


def test_sql_table_function_over_parts(spark):
    from formline.functions import sqlfunctions

    spark.range(500).selectExpr("id", "id % 2 AS k", "CAST(id AS STRING) AS name").createOrReplaceTempView("numbered")
    sqlfunctions.register_latest_rows(spark, "newest_numbers", "numbered", "k", ["id"], ["id", "name"])
    assert [r.id for r in spark.sql("SELECT * FROM newest_numbers(1) ORDER BY id").collect()] == [495, 497, 499]
    assert [r.id for r in spark.sql("SELECT * FROM newest_numbers(0, 2) ORDER BY id").collect()] == [496, 498]
