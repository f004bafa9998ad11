"""Table reads and writes: fallbacks, CSV, overwrite, append, export, backup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.operators.quality import assert_unique
from formline.operators.streaks import newest_rows
from formline.sources.incremental import upsert


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A Parquet path (anything with a slash) or a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def first_non_empty(*frames: DataFrame) -> DataFrame:
    """The first frame that has rows; the last one when none has."""
    for df in frames[:-1]:
        if not df.isEmpty():
            return df
    return frames[-1]


def read_csv_table(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    stray_header: str | None = None,
) -> DataFrame:
    """CSV with a header. Without a schema all columns are text, so nothing is
    inferred; ``stray_header`` drops header lines repeated inside the file;
    equal keys keep one row, chosen by the full row order."""
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    if stray_header:
        df = df.filter(F.lower(F.coalesce(F.col(stray_header), F.lit(""))) != stray_header.lower())
    if keys:
        rest = [c for c in df.columns if c not in keys]
        df = newest_rows(df, keys, rest or list(keys), 1).drop("_rn")
    return df


def _reads(df: DataFrame, path: str) -> bool:
    """Whether a scan of the plan names the folder or one inside it. The root
    paths of the scans are looked at, never the list of their files."""
    target = path.split(":", 1)[-1].rstrip("/").replace("//", "/")
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if not hasattr(leaf, "relation") or "LogicalRelation" not in leaf.getClass().getName():
            continue
        location = leaf.relation().location().rootPaths() if "HadoopFsRelation" in leaf.relation().getClass().getName() else None
        for j in range(location.size() if location is not None else 0):
            root = location.apply(j).toUri().getPath().rstrip("/")
            if root == target or root.startswith(f"{target}/"):
                return True
    return False


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), merge_schema: bool = False, replace_schema: bool = True
) -> None:
    """Replace a table's rows. ``merge_schema`` keeps columns the old table had
    (null in the new rows); without ``replace_schema`` a changed schema is an
    error. The frame must not read from the path it replaces."""
    spark = df.sparkSession
    if merge_schema or not replace_schema:
        old = spark.read.parquet(path).schema
        if merge_schema:
            missing = [f for f in old.fields if f.name not in df.columns]
            df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
        elif sorted(old.names) != sorted(df.columns):
            raise ValueError("schema changed; pass merge_schema or replace_schema")
    if _reads(df, path):
        raise ValueError(f"the frame still reads from {path}; write it elsewhere first")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def solidify(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write and read back: later steps start from files, not from the plan."""
    overwrite(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def solidify_by(df: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """Write a table dealt into ``buckets`` by its keys, in order inside them, and read it back under ``name``.

    Later plans that group, rank or window by the keys, or join two such tables of
    as many buckets on them, find the rows of a key together and need no shuffle.
    Rows are dealt once, here, with a task a bucket, so ``buckets`` bounds the
    tasks of later plans as well: take about one for each gigabyte. Null keys
    share a bucket. The table lies at ``path``, below the name in the session's
    catalog; a table of that name is replaced.
    """
    spark = df.sparkSession
    if _reads(df, path):
        raise ValueError(f"the frame still reads from {path}; write it elsewhere first")
    dealt = df.repartition(buckets, *keys)  # as the buckets are dealt: a file a bucket
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).option("path", path)
    (writer.sortBy(*keys, *order) if order else writer).saveAsTable(name)
    return spark.table(name)


def export_keyed(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Serving copy: the primary key must be unique and non-null."""
    overwrite(assert_unique(df, keys, allow_null=False), path, partition_by)


def create_or_merge(spark: SparkSession, new: DataFrame, current: str | None, target: str, keys: Sequence[str]) -> DataFrame:
    """Keyed feature table: the rows of ``current`` (None at first) with the new
    rows put over them, written to ``target`` and read back. The two paths
    differ, so a failed write leaves the current table whole."""
    rows = assert_unique(new, keys)
    if current is not None:
        rows = upsert(spark.read.parquet(current), rows, keys)
    return solidify(rows, target)


def backup(spark: SparkSession, tables: dict[str, str], target_root: str) -> DataFrame:
    """Copy tables (name -> path) below a folder and compare row counts."""
    report = None
    for name, path in tables.items():
        copy = f"{target_root.rstrip('/')}/{name}"
        overwrite(spark.read.parquet(path), copy)
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("original"))
        copied = spark.read.parquet(copy).agg(F.count(F.lit(1))).scalar()
        line = counted.select(F.lit(name).alias("table"), "original", copied.alias("copied")).withColumn(
            "status", F.when(F.col("original") == F.col("copied"), "OK").otherwise("MISMATCH")
        )
        report = line if report is None else report.unionByName(line)
    return report
