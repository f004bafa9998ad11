"""Streaming appends: file source in, append-only table out.

A file source reads every file once, so rewritten history upstream does not
flow again; corrected data comes through a batch refetch of the lookback window
(``sources.incremental``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from formline.functions.numbers import is_count_name, zero_if_null
from formline.operators.quality import expect


def stream_files(spark: SparkSession, path: str, schema: T.StructType, name_filter: str | None = None, max_files: int | None = None) -> DataFrame:
    """Parquet folder as a stream; TIMESTAMP_NTZ columns become timestamps,
    which watermarks need."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(path)
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def zero_fill(df: DataFrame, types: Sequence[str] = ("int", "bigint")) -> DataFrame:
    """Null counts become 0 in flight (stateless)."""
    return df.select(
        *[zero_if_null(c).alias(c) if t in types and is_count_name(c) else F.col(c) for c, t in df.dtypes]
    )


def dedupe_within(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First row per key among rows at most ``delay`` apart. State is dropped
    as the watermark passes, so it stays bounded for an endless stream; rows later
    than the watermark are dropped by Spark. ``append_first_within`` keeps them."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedupe_forever(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key ever seen. The state holds every key and grows with
    them; use ``dedupe_within`` unless repeats can arrive at any distance."""
    return df.dropDuplicates(list(keys))


def append_table(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet table, exactly once through the checkpoint; with
    ``available_now`` the run takes what is there and ends."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


@contextmanager
def _state_on_disk(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, outside the heap."""
    conf, name = spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        conf.set(name, before)


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_batches(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True, on_batch: Callable[[int], None] | None = None
) -> StreamingQuery:
    """Append a stream to a table with a folder for each batch.

    A batch that is repeated after a failure overwrites its own folder, so rows
    are neither lost nor doubled over any number of restarts on one checkpoint.
    ``on_batch`` is called when a batch is written and not yet committed. Read the
    table with ``read_batches``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if on_batch:
            on_batch(batch_id)

    return _started(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table written by batches; ``batch`` says which one wrote them."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def append_deduped(
    df: DataFrame, keys: Sequence[str], time: str, delay: str, path: str, late: str, checkpoint: str, available_now: bool = True,
    on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append the first row of each key, with the keys of the last ``delay`` held as state.

    The state is Spark's own, in RocksDB: a key is dropped from it when the
    watermark passes its row by ``delay``, so the state is bounded by the keys of
    that span and no stored row is read again. Rows not after the watermark of
    their batch, which that state can't judge, go to ``late`` instead of vanishing,
    as do rows without a time. The watermark is the newest time of all earlier
    batches less ``delay``; each batch writes the newest time so far beside its rows
    (``<path>_clock``), so a repeated batch finds the same one. Keys may be null.
    """
    timed = df.filter(F.col(time).isNotNull())
    fresh = timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys)).withColumn("_fresh", F.lit(True))
    both = fresh.unionByName(df.withColumn("_fresh", F.lit(False)))
    clock = f"{path.rstrip('/')}_clock"

    def newest_before(spark: SparkSession, batch_id: int):
        if batch_id == 0:
            return None
        seen = spark.read.schema("newest timestamp, batch long").parquet(clock).filter(F.col("batch") == batch_id - 1)
        return seen.agg(F.max("newest")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = newest_before(spark, batch_id)
        rows = batch.persist(StorageLevel.DISK_ONLY)
        arrived = rows.filter(~F.col("_fresh")).drop("_fresh")
        mark = F.unix_millis(F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}"))
        behind = F.col(time).isNull() | (F.unix_micros(time) <= F.coalesce(mark, F.lit(0)) * 1000)
        rows.filter("_fresh").drop("_fresh").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        arrived.filter(behind).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        newest = arrived.agg(F.greatest(F.max(time), F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{clock}/batch={batch_id}")
        rows.unpersist()
        if on_batch:
            on_batch(batch_id)

    with _state_on_disk(df.sparkSession):
        return _started(both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def held_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys that a query's state holds after its last batch, a row each with their columns."""
    return spark.read.format("statestore").load(checkpoint).select("key.*")


def append_first_within(
    df: DataFrame, keys: Sequence[str], time: str, delay: str, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append rows that have no row of the same keys at most ``delay`` before
    them in their batch, or within ``delay`` in the table.

    No watermark is used, so a row that comes late, however late, is compared
    with the stored rows of its own time and is never dropped for being late. Of
    the table only the batch's span of time is read. Folders are keyed by batch,
    so a repeated batch overwrites its own files. Set ``max_files`` on the source
    to bound a batch. Rows without a time are compared with nothing and stored.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at, pause = F.col(time), F.expr(f"INTERVAL {delay}")
        rows = batch.persist(StorageLevel.DISK_ONLY)
        low, high = rows.agg(F.min(at - pause), F.max(at + pause)).first()
        order = Window.partitionBy(*keys).orderBy(time)
        fresh = rows.withColumn("_before", F.lag(time).over(order)).filter(
            F.col("_before").isNull() | at.isNull() | (at - pause > F.col("_before"))
        ).drop("_before")
        if low is not None and batch_id > 0:
            stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
            stored = stored.filter((F.col("batch") != batch_id) & at.between(F.lit(low), F.lit(high))).select(
                *[F.col(k).alias(f"_s_{k}") for k in keys], at.alias("_stored")
            )
            same = F.abs(F.unix_micros(at) - F.unix_micros("_stored")) <= F.unix_micros(F.lit(high)) - F.unix_micros(F.lit(high) - pause)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
            fresh = fresh.join(stored, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        rows.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_with_quarantine(df: DataFrame, rules: dict[str, str], path: str, rejected: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Rows that meet every rule go to ``path``, the others to ``rejected``
    with the names of the failed rules. Both folders are keyed by batch, so a
    repeated batch overwrites its own files instead of adding them again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        judged = expect(batch, rules, on_fail="report").persist(StorageLevel.DISK_ONLY)
        bad = F.size("failed_rules") > 0
        judged.filter(~bad).drop("failed_rules").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        judged.filter(bad).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        judged.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
