"""Data-quality gates and reports. Gates act (they count and may raise);
reports return DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions.numbers import ratio, round_half_up
from formline.operators.joins import null_safe_join


class QualityError(ValueError):
    """A gate found data it must not let through."""


def expect(df: DataFrame, rules: dict[str, str], on_fail: str = "drop") -> DataFrame:
    """Apply named SQL predicates; a null result is a failure.

    ``drop`` keeps the rows that meet every rule, ``report`` appends
    ``failed_rules`` (array of names), ``fail`` raises if any row fails.
    """
    passed = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    if on_fail == "drop":
        return df.filter(reduce(lambda a, b: a & b, passed.values()))
    if on_fail == "report":
        failed = F.filter(F.array(*[F.when(~p, F.lit(n)) for n, p in passed.items()]), lambda x: x.isNotNull())
        return df.withColumn("failed_rules", failed)
    if on_fail == "fail":
        counts = df.agg(*[F.count_if(~p).alias(n) for n, p in passed.items()]).first()
        bad = {n: counts[n] for n in passed if counts[n]}
        if bad:
            raise QualityError(f"rows failing expectations: {bad}")
        return df
    raise ValueError("on_fail is drop, report or fail")


def expect_or_fail(checks: DataFrame, rules: dict[str, str]) -> None:
    """Raise unless the one-row validation table meets every rule."""
    row = checks.limit(1).select(*[F.coalesce(F.expr(r), F.lit(False)).alias(n) for n, r in rules.items()]).first()
    bad = [n for n in rules if row is None or not row[n]]
    if bad:
        raise QualityError(f"failed checks: {bad}")


def counted(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Row count (and further aggregates) observed while the frame is written
    or collected anyway: no extra job."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]), watch


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows: ``n`` rows, ``surplus`` = n − 1."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.select(*keys, "n", (F.col("n") - 1).alias("surplus"))


def assert_unique(df: DataFrame, keys: Sequence[str], allow_null: bool = True) -> DataFrame:
    """Raise when a key repeats (or is null); returns the frame unchanged."""
    found = duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("g"), F.sum("surplus").alias("s")).first()
    if found["g"]:
        raise QualityError(f"{found['g']} keys over {list(keys)} repeat, {found['s']} surplus rows")
    if not allow_null:
        missing = df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
        if not missing.isEmpty():
            raise QualityError(f"null in key {list(keys)}")
    return df


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join that cannot multiply rows: the right key is asserted first."""
    return null_safe_join(left, assert_unique(right, on), on, how)


def join_not_empty(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that raises when nothing matches although both sides have rows."""
    matched = null_safe_join(left, right, on, "left_semi")
    if matched.isEmpty() and not left.isEmpty() and not right.isEmpty():
        raise QualityError(f"no row matches on {list(on)}")
    return null_safe_join(left, right, on, how)


def max_per_entity(df: DataFrame, entity: Sequence[str], condition: Column, alias: str = "max_rows") -> DataFrame:
    """One row: the largest number of matching rows any entity has."""
    return df.filter(condition).groupBy(*entity).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias(alias)
    )


def distinct_keys(keys: Sequence[str]) -> Column:
    """Distinct count over several columns; a null is a value of its own."""
    return F.count_distinct(F.struct(*keys))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus"),
    )


def freshness(df: DataFrame, date: str, as_of: Column, upcoming: Column) -> DataFrame:
    """One row: latest date, upcoming rows, and whether the table is current."""
    latest = F.max(F.to_date(F.col(date)))
    return df.agg(
        latest.alias("max_date"),
        F.count_if(upcoming).alias("upcoming_rows"),
        (latest >= as_of).cast("int").alias("is_fresh"),
    )


def completeness(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """One row: share of non-null values per column and the worst of them."""
    rows = df if condition is None else df.filter(condition)
    total = F.count(F.lit(1))
    shares = rows.agg(total.alias("n_rows"), *[ratio(F.count(c), total, 4).alias(f"{c}_filled") for c in columns])
    return shares.withColumn("worst_filled", F.least(*[F.col(f"{c}_filled") for c in columns], F.lit(1.0)))


def out_of_range(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """One row: values of each column outside [low, high], and rows with any."""
    outside = {}
    for c, (low, high) in bounds.items():
        parts = []
        if low is not None:
            parts.append(F.col(c) < low)
        if high is not None:
            parts.append(F.col(c) > high)
        outside[c] = F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))
    anywhere = reduce(lambda a, b: a | b, outside.values())
    return df.agg(
        *[F.count_if(o).alias(f"{c}_out") for c, o in outside.items()], F.count_if(anywhere).alias("rows_out")
    )


def readiness_report(df: DataFrame, checks: Sequence[tuple[str, Column, Callable[[Column], Column], str]]) -> DataFrame:
    """(check, value, status, expectation) rows from one aggregation pass.

    Each check is (name, aggregate, test of the value, what is expected)."""
    values = df.agg(*[value.cast("double").alias(f"_v{i}") for i, (_, value, _, _) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(f"_v{i}").alias("value"),
            F.when(test(F.col(f"_v{i}")), "PASS").otherwise("FAIL").alias("status"),
            F.lit(expected).alias("expectation"),
        )
        for i, (name, _, test, expected) in enumerate(checks)
    ]
    return values.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def layer_profile(layers: dict[str, tuple[DataFrame, Sequence[str], str | None]]) -> DataFrame:
    """Rows, distinct keys and date span of several tables (name -> frame, key
    columns, date column). Keys are counted by grouping, not in one task."""
    parts = []
    for name, (df, keys, date) in layers.items():
        day = F.to_date(F.col(date)) if date else F.lit(None).cast("date")
        per_key = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"), F.min(day).alias("_lo"), F.max(day).alias("_hi")
        )
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                F.count(F.lit(1)).alias("n_keys"),
                F.min("_lo").cast("string").alias("min_date"),
                F.max("_hi").cast("string").alias("max_date"),
            ).select(F.lit(name).alias("layer"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def feature_summary(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Per column: nulls, minimum, mean and maximum, in one pass."""
    stats = [
        s
        for i, c in enumerate(columns)
        for s in (
            F.count_if(F.col(c).isNull()).alias(f"n{i}"),
            F.min(F.col(c).cast("double")).alias(f"lo{i}"),
            round_half_up(F.avg(F.col(c).cast("double")), digits).alias(f"mean{i}"),
            F.max(F.col(c).cast("double")).alias(f"hi{i}"),
        )
    ]
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"mean{i}").alias("mean_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*stats).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def categorical_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column, counted over (column, value) groups so that
    the columns are scanned once and no set of values is held in one task."""
    values = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    pairs = df.select(F.explode(values).alias("_p")).select("_p.*").filter("v is not null").distinct()
    base = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    counts = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
    return base.join(counts, "feature", "left").fillna({"n_values": 0})


def bucket_histogram(df: DataFrame, value: str, edges: Sequence[tuple[str, float | None]]) -> DataFrame:
    """Rows per bucket; ``edges`` lists (label, upper bound exclusive) in
    rising order, None for the open end; nulls form the bucket ``null``."""
    bucket = F.when(F.col(value).isNull(), "null")
    for label, upper in edges:
        bucket = bucket.when(F.lit(True) if upper is None else F.col(value) < upper, label)
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def schema_problems(
    df: DataFrame, required: dict[str, str], forbidden: Sequence[str] = ()
) -> list[str]:
    """Contract violations of a schema: missing, mistyped, forbidden columns."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [f"missing {c}" for c in required if c not in have]
    problems += [f"{c} is {have[c]}, not {t}" for c, t in required.items() if c in have and have[c] != t]
    return problems + [f"forbidden {c}" for c in forbidden if c in have]


def assert_same_schema(a: DataFrame, b: DataFrame) -> None:
    def shape(df) -> T.StructType:
        return sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)

    if shape(a) != shape(b):
        differing = set(shape(a)) ^ set(shape(b))
        raise QualityError(f"schemas differ: {sorted(differing)}")
