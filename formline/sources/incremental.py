"""Idempotent incremental loads: windows, spines, appends, merges, diffs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.operators.joins import null_safe_join
from formline.operators.shape import union_all
from formline.operators.streaks import newest_rows


def fetch_window(stored: DataFrame, date: str, today: Column, lookback: int, fallback_start: str) -> DataFrame:
    """One row (start_date, end_date): from the latest stored date minus the
    lookback, and never later than yesterday, up to today; from the fallback
    date when nothing is stored."""
    latest = F.max(F.to_date(F.col(date)))
    start = F.least(F.date_sub(latest, lookback), F.date_sub(today, 1))
    return stored.agg(
        F.coalesce(F.when(latest.isNotNull(), start), F.lit(fallback_start).cast("date")).alias("start_date"),
        F.max(today).alias("end_date"),
    )


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date", alias: str = "day") -> DataFrame:
    """One row per calendar day between the bounds of each row."""
    usable = bounds.filter(F.col(start) <= F.col(end))
    return usable.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias(alias))


def new_rows_only(new: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``existing``; a key repeated in
    ``new`` keeps its first row in ``order``."""
    fresh = null_safe_join(new, existing.select(*keys), keys, "left_anti")
    return newest_rows(fresh, keys, order, 1).drop("_rn")


def append_new(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], order: Sequence) -> None:
    """Append only rows whose key the table does not hold: safe to repeat."""
    existing = spark.read.parquet(path)
    new_rows_only(new, existing, keys, order).select(*existing.columns).write.mode("append").parquet(path)


def priority_merge(sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence = ()) -> DataFrame:
    """Union of the sources, one row per key: earlier sources win, then the
    first row in ``order``."""
    marked = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(sources)]
    return newest_rows(union_all(*marked), keys, ["_priority", *order], 1).drop("_rn", "_priority")


def refresh(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Existing and new rows, unique by key, the first in ``order`` kept."""
    return newest_rows(union_all(existing, new), keys, order, 1).drop("_rn")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace old rows of the same key; other old rows stay."""
    return union_all(new, null_safe_join(old, new.select(*keys), keys, "left_anti"))


def upsert_keeping(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert by column: a null in the new row keeps the old value."""
    values = [c for c in old.columns if c not in keys]
    n = new.withColumnsRenamed({c: f"_n_{c}" for c in new.columns})
    matched = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys])
    joined = old.withColumn("_old", F.lit(True)).join(n.withColumn("_new", F.lit(True)), matched, "full_outer")
    return joined.select(
        *[F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_n_{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in new.columns else F.col(c) for c in values],
    )


def dedupe_keep_lowest(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    return newest_rows(df, keys, [F.col(row_id).asc_nulls_last()], 1).drop("_rn")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], alias: str = "change") -> DataFrame:
    """(keys, change) with ``insert``, ``update`` or ``delete``; equal rows are
    left out. Rows are compared by value, nulls equal to nulls."""
    values = [c for c in new.columns if c not in keys]
    n = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*values).alias("_nv"), F.lit(True).alias("_new"))
    o = old.select(*keys, F.struct(*values).alias("_ov"), F.lit(True).alias("_old"))
    matched = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys])
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_ov").eqNullSafe(F.col("_nv")), "update")
    )
    both = o.join(n, matched, "full_outer")
    return both.select(
        *[F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_n_{k}")).alias(k) for k in keys], change.alias(alias)
    ).filter(F.col(alias).isNotNull())
