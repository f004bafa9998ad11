"""Streams over several runs on one checkpoint: state that expires, rows that come late, batches that are repeated."""

from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from formline.streaming import append

START = datetime(2024, 1, 1)
SCHEMA = "k string, n int, ts timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes) if minutes is not None else None


@pytest.fixture
def feed(spark, tmp_path):
    """``send(rows)`` adds a file of (key, number, minutes); ``run(...)`` takes what is there."""
    names = {n: f"{tmp_path}/{n}" for n in ("source", "table", "late", "state")}

    class Feed:
        def send(self, rows):
            spark.createDataFrame([(k, n, at(m)) for k, n, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(names["source"])

        def run(self, on_batch=None, delay="10 MINUTES"):
            stream = append.stream_files(spark, names["source"], spark.createDataFrame([], SCHEMA).schema, max_files=1)
            append.append_deduped(stream, ["k"], "ts", delay, names["table"], names["late"], names["state"], on_batch=on_batch).awaitTermination()

        def rows(self, name):
            return rows_of(append.read_batches(spark, names[name], spark.createDataFrame([], SCHEMA).schema), "k", "n")

        def held(self):
            return rows_of(append.held_keys(spark, names["state"]))

    return Feed()


def test_state_expires_and_late_rows_are_kept_apart(feed):
    feed.send([("a", 1, 0), ("b", 2, 3), ("a", 3, 4), (None, 4, 5), (None, 5, 5)])
    feed.run()
    assert [k for k, _ in feed.rows("table")] == ["a", "b", None] and feed.rows("late") == []
    feed.send([("a", 6, 9), ("c", 7, 30)])  # a is held still
    feed.run()
    assert ("c", 7) in feed.rows("table") and ("a", 6) not in feed.rows("table")
    assert feed.held() == [("c",)]  # the mark is at 20 minutes: the others have expired
    feed.send([("a", 8, 21), ("d", 9, 20), ("e", 10, 2), ("f", 11, None)])
    feed.run()
    assert ("a", 8) in feed.rows("table")  # first of its key again after its time
    assert feed.rows("late") == [("d", 9), ("e", 10), ("f", 11)]
    assert feed.held() == [("a",), ("c",)]


def test_a_batch_that_breaks_is_repeated(feed):
    def breaks(batch):
        raise RuntimeError(f"not committed {batch}")

    feed.send([("a", 1, 0), ("b", 2, 60)])
    feed.run()
    feed.send([("a", 3, 1), ("c", 4, 61), ("b", 5, 62)])
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            feed.run(on_batch=breaks)
    feed.run()
    feed.run()
    assert feed.rows("table") == [("a", 1), ("b", 2), ("c", 4)] and feed.rows("late") == [("a", 3)]


def test_the_state_does_not_grow_with_the_stream(feed):
    for hour in range(4):
        feed.send([(f"{hour}-{i}", i, 60 * hour) for i in range(50)])
    feed.run()
    assert len(feed.rows("table")) == 200 and len(feed.held()) == 50


def test_batches_over_restarts(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, shots int").schema
    calls = []

    def fails_once(batch):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("not committed")

    def run():
        stream = append.zero_fill(append.stream_files(spark, f"{tmp_path}/source", schema, max_files=1))
        append.append_batches(stream, f"{tmp_path}/table", f"{tmp_path}/state", on_batch=fails_once).awaitTermination()

    for part in range(3):
        spark.range(100 * part, 100 * part + 100).select(F.col("id").cast("int").alias("k"), F.lit(None).cast("int").alias("shots")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
    with pytest.raises(StreamingQueryException):
        run()
    run()
    run()
    rows = append.read_batches(spark, f"{tmp_path}/table", schema)
    assert rows.count() == 300 and rows.select("k").distinct().count() == 300 and rows.filter("shots <> 0").count() == 0
    assert rows.select("batch").distinct().count() == 3 and len(calls) == 4
