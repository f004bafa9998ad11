"""Tables, incremental loads, streams and quality gates."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import quality
from formline.sources import incremental, tables
from formline.streaming import append


def test_csv_with_stray_headers(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("DATE,HOME\n10/1/2024,BOS\nDATE,HOME\n10/2/2024,TOR\n10/1/2024,BOS\n")
    df = tables.read_csv_table(spark, str(path), keys=["DATE", "HOME"], stray_header="DATE")
    assert rows_of(df) == [("10/1/2024", "BOS"), ("10/2/2024", "TOR")]
    assert [t for _, t in df.dtypes] == ["string", "string"]


def test_overwrite_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.createDataFrame([(1, "a")], "k int, s string"), path)
    tables.overwrite(spark.createDataFrame([(2, 5)], "k int, v int"), path, merge_schema=True)
    assert rows_of(spark.read.parquet(path), "k", "v", "s") == [(2, 5, None)]
    with pytest.raises(ValueError):
        tables.overwrite(spark.createDataFrame([(1,)], "k int"), path, replace_schema=False)
    with pytest.raises(ValueError):
        tables.overwrite(spark.read.parquet(path), path)
    assert tables.solidify(spark.range(3).toDF("k"), str(tmp_path / "u")).count() == 3


def test_fallback_export_backup(spark, tmp_path):
    empty, full = spark.range(0), spark.range(2)
    assert tables.first_non_empty(empty, full).count() == 2
    assert tables.first_non_empty(empty, empty).count() == 0
    with pytest.raises(quality.QualityError):
        tables.export_keyed(full.union(full), str(tmp_path / "e"), ["id"])
    with pytest.raises(quality.QualityError):
        tables.export_keyed(full.select(F.lit(None).cast("int").alias("id")).limit(1), str(tmp_path / "e"), ["id"])
    tables.export_keyed(full, str(tmp_path / "e"), ["id"])
    report = tables.backup(spark, {"e": str(tmp_path / "e")}, str(tmp_path / "copy"))
    assert rows_of(report) == [("e", 2, 2, "OK")]
    assert tables.read_table(spark, str(tmp_path / "copy" / "e")).count() == 2


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "old")], "k int, s string").write.parquet(path)
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, s string")
    for _ in range(2):
        incremental.append_new(spark, batch, path, ["k"], ["s"])
    assert rows_of(spark.read.parquet(path)) == [(1, "old"), (2, "a")]


def test_merge_and_window(spark):
    api = spark.createDataFrame([(1, "api")], "k int, s string")
    manual = spark.createDataFrame([(1, "manual"), (2, "manual")], "k int, s string")
    assert rows_of(incremental.priority_merge([api, manual], ["k"])) == [(1, "api"), (2, "manual")]
    stored = spark.createDataFrame([("2024-01-20",)], "d string")
    today = F.lit("2024-01-21").cast("date")
    window = incremental.fetch_window(stored, "d", today, 0, "2023-10-01")
    assert [tuple(map(str, r)) for r in window.collect()] == [("2024-01-20", "2024-01-21")]
    late = incremental.fetch_window(stored, "d", F.lit("2024-02-01").cast("date"), 1, "2023-10-01")
    assert str(late.first().start_date) == "2024-01-19"
    first = incremental.fetch_window(stored.limit(0), "d", today, 1, "2023-10-01")
    assert first.first().start_date is not None and str(first.first().start_date) == "2023-10-01"
    assert incremental.date_spine(window).count() == 2


def test_stream_dedupe_and_second_run(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(1000).select(
        F.col("id").alias("k"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"),
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("n"),
    )
    rows.union(rows.limit(50)).write.parquet(source)

    def run():
        stream = append.stream_files(spark, source, rows.schema)
        once = append.dedupe_within(append.zero_fill(stream), ["k"], "ts", "1 hour")
        append.append_table(once, out, state).awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 1000
    assert run().filter("n is null").count() == 0
    later = spark.createDataFrame([(5000, 1)], "k long, n long").select(
        "k", F.lit("2024-01-01 01:00:00").cast("timestamp_ntz").alias("ts"), "n"
    )
    later.write.mode("append").parquet(source)
    assert run().count() == 1001


def test_late_rows_of_a_stream_are_kept(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k int, ts timestamp, v int"
    files = [
        [(1, "2024-01-05 10:00:00", 1), (1, "2024-01-05 10:05:00", 2), (2, "2024-01-05 10:00:00", 3)],
        [(1, "2024-01-05 10:20:00", 4), (1, "2024-01-05 10:09:00", 5), (None, "2024-01-05 10:00:00", 6)],
        [(1, "2024-01-01 00:00:00", 7), (3, "2023-12-01 00:00:00", 8), (2, "2024-01-05 09:55:00", 9), (None, "2024-01-05 10:01:00", 10)],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "k int, ts string, v int").selectExpr("k", "CAST(ts AS timestamp) AS ts", "v").coalesce(1).write.parquet(f"{source}/f={i}")
        stream = append.stream_files(spark, source + "/*", spark.createDataFrame([], schema).schema, max_files=1)
        append.append_first_within(stream, ["k"], "ts", "10 MINUTES", out, state).awaitTermination()
    assert [v for (v,) in rows_of(spark.read.schema(schema).parquet(out), "v")] == [1, 3, 4, 6, 7, 8]


def test_stream_quarantine(spark, tmp_path):
    source, out, bad, state = (str(tmp_path / n) for n in ("in", "out", "bad", "state"))
    df = spark.createDataFrame([(1, 5), (None, 6), (3, -1)], "k int, n int")
    df.write.parquet(source)
    stream = append.stream_files(spark, source, df.schema)
    rules = {"key": "k is not null", "positive": "n > 0"}
    append.append_with_quarantine(stream, rules, out, bad, state).awaitTermination()
    assert rows_of(spark.read.parquet(out), "k", "n") == [(1, 5)]
    assert rows_of(spark.read.parquet(bad).select(F.concat_ws(",", "failed_rules"))) == [("key",), ("positive",)]


def test_gates(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (2, 7)], "k int, v int")
    assert quality.expect(df, {"v": "v > 0"}).count() == 2
    with pytest.raises(quality.QualityError, match="v"):
        quality.expect(df, {"v": "v > 0"}, "fail")
    with pytest.raises(quality.QualityError):
        quality.assert_unique(df, ["k"])
    with pytest.raises(quality.QualityError):
        quality.join_unique(df, df, ["k"])
    with pytest.raises(quality.QualityError):
        quality.join_not_empty(df, df.withColumn("k", F.col("k") + 10), ["k"])
    assert quality.join_not_empty(df, df.limit(0), ["k"]).count() == 0
    with pytest.raises(quality.QualityError):
        quality.expect_or_fail(df.agg(F.max("k").alias("m")), {"small": "m < 2"})
    watched, seen = quality.counted(df, "rows seen", top=F.max("k"))
    watched.collect()
    assert seen.get == {"rows": 3, "top": 2}
    assert quality.schema_problems(df, {"k": "bigint", "x": "int"}, ["v"]) == ["missing x", "k is int, not bigint", "forbidden v"]
    quality.assert_same_schema(df, df.select("v", "k"))
    with pytest.raises(quality.QualityError):
        quality.assert_same_schema(df, df.drop("v"))


def test_solid_tables_need_no_shuffle(spark, tmp_path):
    """Windows, aggregates and joins on the keys of two solid tables: rows as before, and no exchange in the plan."""
    from pyspark.sql import Window

    rows = spark.range(2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("t"), (F.col("id") * 7 % 101).alias("v")).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    names = rows.select("k").distinct().withColumn("name", F.concat(F.lit("n"), F.col("k")))

    def form(a, b):
        line = Window.partitionBy("k").orderBy("t")
        placed = a.withColumn("before", F.lag("v").over(line)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
        return placed.join(b, "k", "left").join(a.groupBy("k").agg(F.sum("v").alias("s")), "k", "left")

    solid = [tables.solidify_by(d, n, f"{tmp_path}/{n}", ["k"], o, buckets=4) for d, n, o in ((rows, "solid_rows", ["t"]), (names, "solid_names", []))]
    joins = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(joins)
    spark.conf.set(joins, "-1")
    try:
        found = form(*solid)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert "Exchange" in form(rows, names)._jdf.queryExecution().executedPlan().toString()
        assert rows_of(found) == rows_of(form(rows, names))
    finally:
        spark.conf.set(joins, before)
    again = tables.solidify_by(rows.limit(5), "solid_rows", f"{tmp_path}/solid_rows", ["k"], buckets=4)
    assert again.count() == 5
    with pytest.raises(ValueError):
        tables.solidify_by(again, "solid_rows", f"{tmp_path}/solid_rows", ["k"], buckets=4)


def test_default_start_times(spark):
    from formline.operators.schedule import with_day_and_times

    games = spark.createDataFrame([("2024-01-05", "8:00 PM"), ("2024-01-06", None), (None, None)], "DATE string, EASTERN string")
    got = rows_of(with_day_and_times(games, "DATE"), "DAY", "EASTERN", "LOCAL")
    unknown = "7:00 PM Default"
    assert got == [("Fri", "8:00 PM", unknown), ("Sat", unknown, unknown), (None, unknown, unknown)]
