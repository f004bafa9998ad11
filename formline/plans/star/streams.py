"""Streams of the events: appended over restarts, without repeats, and with a quarantine."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.plans.star.registry import query, table
from formline.session import checkpoint_dir
from formline.streaming import append


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _add(rows: DataFrame, source: str, files: int = 4) -> None:
    """Rows as further files of a stream's source, of about a million rows each, and some at least."""
    rows.repartition(max(files, rows.count() // 1_000_000)).write.mode("append").parquet(source)


class _Broken(RuntimeError):
    pass


def _breaks(batch_id: int) -> None:
    raise _Broken(f"batch {batch_id} is written and not committed")


def _until_it_breaks(start) -> None:
    """Run a stream whose first batch fails after it is written."""
    try:
        start(_breaks).awaitTermination()
    except StreamingQueryException as failed:
        if "is written and not committed" not in str(failed):
            raise


@query(
    "stream_dedupe_append",
    "SELECT event_id, user_id, event_type, value FROM events WHERE value >= 1",
)
def stream_dedupe_append(spark, folder):
    """The events arrive, half of them twice, in files of any order, two at a
    time; each is appended once, and values below 1 are turned away."""
    root, events = _root(spark), _events(spark, folder)
    _add(events, f"{root}/source")
    _add(events.filter("event_id % 2 = 0"), f"{root}/source", files=2)
    arriving = append.stream_files(spark, f"{root}/source", events.schema, max_files=2)
    kept = append.expect(append.zero_fill(arriving), {"worth it": "value >= 1"})
    append.append_first_within(kept, ["event_id"], "ts", "10 MINUTES", f"{root}/table", f"{root}/state").awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{root}/table").select("event_id", "user_id", "event_type", "value")


@query("stream_append_restart", "SELECT event_id, user_id, event_type, COALESCE(value, 0) AS value, 1 AS times FROM events")
def stream_append_restart(spark, folder):
    """Files arrive, are appended, and more arrive; the run that takes those
    breaks when its first batch is written and not committed, and the next one
    goes on. ``times`` counts an event's rows in the table."""
    root, events = _root(spark), _events(spark, folder)

    def start(on_batch=None):
        arriving = append.zero_fill(append.stream_files(spark, f"{root}/source", events.schema, max_files=2))
        return append.append_batches(arriving, f"{root}/table", f"{root}/state", on_batch=on_batch)

    _add(events.filter("event_id % 3 > 0"), f"{root}/source")
    start().awaitTermination()
    _add(events.filter("event_id % 3 = 0"), f"{root}/source")
    _until_it_breaks(start)
    start().awaitTermination()
    rows = append.read_batches(spark, f"{root}/table", events.schema)
    once = rows.groupBy("event_id", "user_id", "event_type", "value").agg(F.count(F.lit(1)).cast("int").alias("times"))
    return once.withColumn("value", F.coalesce("value", F.lit(0.0)))


@query(
    "stream_state_dedupe",
    """
    WITH e AS (SELECT event_id, epoch_us(ts) AS t, event_id % 3 = 2 AND ts < (SELECT MAX(ts) FROM events) AS second FROM events),
    w AS (SELECT 1000 * (MAX(t) // 1000 - 172800000) AS mark FROM e),
    kept AS (SELECT event_id, t FROM e, w WHERE NOT second OR t > mark)
    SELECT event_id, 'kept' AS outcome FROM kept
    UNION ALL SELECT event_id, 'late' FROM e, w WHERE second AND t <= mark
    UNION ALL SELECT event_id, 'late' FROM e, w WHERE event_id % 3 = 0 AND t <= mark
    UNION ALL SELECT event_id, 'held' FROM kept, w WHERE t + 172800000000 > mark""",
)
def stream_state_dedupe(spark, folder):
    """Two waves of events on one checkpoint, keys held for two days.

    The second wave brings the third part of the events, among older ones, and a
    third of the first wave again, and breaks once. What is appended (kept), what
    came after its time (late), and which keys the state still holds (held).
    """
    root, events = _root(spark), _events(spark, folder)

    def start(on_batch=None, max_files=2):
        arriving = append.stream_files(spark, f"{root}/source", events.schema, max_files=max_files)
        return append.append_deduped(arriving, ["event_id"], "ts", "2 DAYS", f"{root}/table", f"{root}/late", f"{root}/state", on_batch=on_batch)

    second = (F.col("event_id") % 3 == 2) & (F.col("ts") < events.agg(F.max("ts")).scalar())
    _add(events.filter(~second), f"{root}/source")
    start(max_files=None).awaitTermination()  # one batch, whatever the order of its files
    _add(events.filter(second), f"{root}/source")
    _add(events.filter("event_id % 3 = 0"), f"{root}/source", files=2)
    _until_it_breaks(start)
    start().awaitTermination()
    kept, late = (append.read_batches(spark, f"{root}/{name}", events.schema).select("event_id", F.lit(label).alias("outcome")) for name, label in (("table", "kept"), ("late", "late")))
    held = append.held_keys(spark, f"{root}/state").select("event_id", F.lit("held").alias("outcome"))
    return kept.unionByName(late).unionByName(held)


@query(
    "stream_quarantine",
    """
    SELECT event_id, array_to_string(list_filter([CASE WHEN NOT COALESCE(value >= 20, FALSE) THEN 'large enough' END, CASE WHEN NOT COALESCE(event_type <> 'click', FALSE) THEN 'no click' END], lambda x: x IS NOT NULL), '+') AS failed
    FROM events""",
)
def stream_quarantine(spark, folder):
    """Events that meet both rules, and those turned away with the rules they fail."""
    root, events = _root(spark), _events(spark, folder)
    _add(events, f"{root}/source")
    rules = {"large enough": "value >= 20", "no click": "event_type <> 'click'"}
    arriving = append.stream_files(spark, f"{root}/source", events.schema, max_files=2)
    append.append_with_quarantine(arriving, rules, f"{root}/table", f"{root}/rejected", f"{root}/state").awaitTermination()
    good = append.read_batches(spark, f"{root}/table", events.schema).select("event_id", F.lit("").alias("failed"))
    named = T.StructType([*events.schema.fields, T.StructField("failed_rules", T.ArrayType(T.StringType()))])
    bad = append.read_batches(spark, f"{root}/rejected", named).select("event_id", F.array_join("failed_rules", "+").alias("failed"))
    return good.unionByName(bad)
