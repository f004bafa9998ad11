"""Ordered windows that hold when one group carries much of the table.

``over_ordered`` evaluates running values and short row frames per group. A
group of ordinary size takes a plain Spark window. A group with more rows than
``formline.hotGroupRows`` would land in one task, so its rows are range
partitioned by (group, order) into blocks instead: each block is evaluated on
its own, short frames see the few neighbouring rows copied in from the blocks
beside it, and running values start from a carry summed over the earlier
blocks. Both ways give the same rows; only the measured group size decides.
Running sums of doubles are added in another order by blocks, so they may differ
in the last bits; sum decimals where that matters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from formline.operators.joins import null_safe_join
from formline.session import reliable_checkpoint

HOT_ROWS_CONF = "formline.hotGroupRows"
HOT_ROWS_DEFAULT = 2_000_000
MAX_LISTED_KEYS = 10_000


@dataclass(frozen=True)
class Running:
    """Value over all rows up to the current one, or strictly before it.

    ``kind`` is ``sum``, ``count``, ``max`` or ``last`` (last non-null value).
    """

    alias: str
    column: Column
    kind: str = "sum"
    strict: bool = False

    def aggregate(self, column: Column) -> Column:
        if self.kind == "last":
            return F.last(column, ignorenulls=True)
        return {"sum": F.sum, "count": F.count, "max": F.max}[self.kind](column)

    def over(self, window: WindowSpec, column: Column | None = None) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, -1 if self.strict else 0)
        return self.aggregate(self.column if column is None else column).over(frame)


@dataclass(frozen=True)
class Framed:
    """Any expression over the ordered group that looks at most ``back`` rows
    behind and ``ahead`` rows past the current row."""

    alias: str
    build: Callable[[WindowSpec], Column]
    back: int = 0
    ahead: int = 0

    def over(self, window: WindowSpec) -> Column:
        return self.build(window)


def hot_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def hot_groups(df: DataFrame, keys: Sequence[str], bounded_by: Sequence[DataFrame] | int = ()) -> DataFrame | None:
    """Groups of ``df`` above the limit as (keys, ``_rows``), or None.

    ``bounded_by`` is an upper bound of the rows of ``df``, or frames whose
    summed row count is one; counting a plain scan reads file footers only, so
    small inputs skip the grouping.
    """
    limit = hot_limit(df.sparkSession)
    if bounded_by:
        bound = bounded_by if isinstance(bounded_by, int) else sum(f.count() for f in bounded_by)
        if bound <= limit:
            return None
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    listed = counted.orderBy(F.desc("_rows")).limit(MAX_LISTED_KEYS + 1).collect()
    if not listed:
        return None
    if len(listed) <= MAX_LISTED_KEYS:  # counted, so sent to the rows: a join by these keys would put each group into one task
        return F.broadcast(df.sparkSession.createDataFrame(listed, counted.schema))
    return reliable_checkpoint(counted)


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups)."""
    if hot is None:
        return df, None
    if not keys:
        return df.limit(0), df
    marks = hot.select(*keys)
    return null_safe_join(df, marks, keys, "left_anti"), null_safe_join(df, marks, keys, "left_semi")


def over_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    outputs: Sequence[Running | Framed],
    hot: DataFrame | None | str = "measure",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """Append ``outputs`` evaluated per ``keys`` in ``order``.

    ``order`` takes names or sort expressions and should be unique per group.
    ``hot`` takes the result of ``hot_groups`` when several calls share keys.
    """
    if isinstance(hot, str):
        hot = hot_groups(df, keys, bounded_by)
    cold_rows, hot_rows = split_hot(df, keys, hot)
    window = Window.partitionBy(*keys).orderBy(*order)
    plain = cold_rows.select("*", *[o.over(window).alias(o.alias) for o in outputs])
    if hot_rows is None:
        return plain
    total = hot.agg(F.sum("_rows")).first()[0]
    blocked = _by_blocks(hot_rows, keys, order, outputs, total)
    types = {f.name: f.dataType for f in plain.schema.fields}
    blocked = blocked.select(*[F.col(c).cast(types[c]).alias(c) for c in plain.columns])
    return blocked if not keys else plain.unionByName(blocked)


def ordered_blocks(rows: DataFrame, keys: Sequence[str], order: Sequence, total: int) -> DataFrame:
    """Rows with ``_pos`` (their place in the order of keys and order columns)
    and ``_block`` (the range partition they fell into), frozen by a checkpoint
    so that every later step sees the same blocks."""
    count = max(2, math.ceil(total / max(1, hot_limit(rows.sparkSession) // 2)))
    ranged = rows.repartitionByRange(count, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = ranged.withColumn("_pos", F.monotonically_increasing_id())
    return reliable_checkpoint(placed.withColumn("_block", F.shiftright("_pos", 33)))


def _by_blocks(rows, keys, order, outputs, total):
    blocks = ordered_blocks(rows, keys, order, total)
    framed = [o for o in outputs if isinstance(o, Framed)]
    running = [o for o in outputs if isinstance(o, Running)]
    back = max([o.back for o in framed], default=0)
    ahead = max([o.ahead for o in framed], default=0)

    inputs = blocks.withColumn("_halo", F.lit(False))
    for halo in _halos(blocks, keys, back, ahead):
        inputs = inputs.unionByName(halo.withColumn("_halo", F.lit(True)))

    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    own = ~F.col("_halo")
    local = inputs.select(
        "*",
        *[o.over(window).alias(o.alias) for o in framed],
        *[o.over(window, F.when(own, o.column)).alias(f"_l{i}") for i, o in enumerate(running)],
    ).filter(own)
    if running:
        local = null_safe_join(local, _carries(blocks, keys, running), [*keys, "_block"], "left")
        local = local.select(
            "*", *[_merge(o, F.col(f"_l{i}"), F.col(f"_c{i}")).alias(o.alias) for i, o in enumerate(running)]
        )
    return local


def _carries(blocks, keys, running):
    """Per (group, block): each running value over all earlier blocks."""
    def total(o):
        if o.kind == "last":
            return F.max_by(o.column, F.when(o.column.isNotNull(), F.col("_pos")))
        return o.aggregate(o.column)

    totals = blocks.groupBy(*keys, "_block").agg(*[total(o).alias(f"_t{i}") for i, o in enumerate(running)])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    def carry(i, o):
        if o.kind == "last":
            return F.last(f"_t{i}", ignorenulls=True).over(before)
        return (F.max if o.kind == "max" else F.sum)(f"_t{i}").over(before)

    return totals.select(*keys, "_block", *[carry(i, o).alias(f"_c{i}") for i, o in enumerate(running)])


def _merge(o, local, carry):
    if o.kind == "last":
        return F.coalesce(local, carry)
    if o.kind == "max":
        return F.greatest(local, carry)
    return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)


def _halos(blocks, keys, back, ahead):
    """Copies of the rows each block needs from the blocks before and after it."""
    sizes = blocks.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    in_group = Window.partitionBy(*keys).orderBy("_block")
    in_block = Window.partitionBy(*keys, "_block")

    def copies(depth, edge_order, seen, first, last, kept=F.lit(True)):
        edge = blocks.withColumn("_r", F.row_number().over(in_block.orderBy(edge_order)))
        edge = edge.filter(F.col("_r") <= depth).drop("_r", "_block")
        edge = edge.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy("_pos")))
        need = sizes.select(*keys, "_block", seen.alias("_seen")).filter(kept).select(
            *keys, "_block", F.explode(F.sequence(first, last)).alias("_nth")
        )
        return null_safe_join(edge, need, [*keys, "_nth"], "inner").select(*blocks.columns)

    seen = F.col("_seen")
    if back:
        tails = F.sum(F.least("_n", F.lit(back))).over(in_group.rowsBetween(Window.unboundedPreceding, -1))
        first = F.greatest(F.lit(1).cast("long"), seen - F.lit(back - 1))
        yield copies(back, F.desc("_pos"), tails, first, F.greatest(first, seen), seen > 0)
    if ahead:
        heads = F.sum(F.least("_n", F.lit(ahead))).over(in_group.rowsBetween(Window.unboundedPreceding, 0))
        yield copies(ahead, F.asc("_pos"), heads, seen + 1, seen + ahead)
