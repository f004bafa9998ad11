"""Joins with a twist: either-order pairs, intervals, tolerances, nearest
dates, tiered lookups and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.operators.joins import broadcast_if_small, left_join_many, null_safe_join
from formline.operators.ordered import Running, hot_groups, over_ordered
from formline.operators.shape import union_all


def with_pair(df: DataFrame, a: str, b: str, low: str = "pair_low", high: str = "pair_high") -> DataFrame:
    """Canonical pair columns, so that an either-order match is an equi join."""
    return df.select("*", F.least(a, b).alias(low), F.greatest(a, b).alias(high))


def opponent_totals(df: DataFrame, game: str, team: str, opponent: str, measures: dict[str, str]) -> DataFrame:
    """Each row with measures of the opponent's row of the same game
    (measure -> new name)."""
    other = df.select(
        F.col(game).alias("_g"), F.col(team).alias("_t"), *[F.col(m).alias(a) for m, a in measures.items()]
    )
    return df.join(other, (F.col(game) == F.col("_g")) & (F.col(opponent) == F.col("_t")), "left").drop("_g", "_t")


def lookup(df: DataFrame, code: str, table: DataFrame, key: str, value: str, alias: str, default: str | None = "Unknown") -> DataFrame:
    """Left join to a lookup table, broadcast when it is counted as small."""
    entries = table.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(broadcast_if_small(entries), F.col(code) == F.col("_key"), "left")
    return joined.select(*df.columns, F.coalesce("_value", F.lit(default)).alias(alias))


def two_tier_lookup(
    df: DataFrame, table: DataFrame, first: Sequence[str], second: Sequence[str], values: Sequence[str], tier: str | None = None,
    second_table: DataFrame | None = None,
) -> DataFrame:
    """Values by the first key, else by the second (e.g. by id, else by name),
    the second from ``second_table`` when given. Each table must be unique per
    its key; see ``quality.assert_unique``."""
    by_first = table.select(*first, *[F.col(v).alias(f"_1_{v}") for v in values], F.lit(1).alias("_hit1"))
    by_second = (table if second_table is None else second_table).select(*second, *[F.col(v).alias(f"_2_{v}") for v in values], F.lit(2).alias("_hit2"))
    joined = df.join(by_first, list(first), "left").join(by_second, list(second), "left")
    found = F.col("_hit1").isNotNull()
    out = [F.when(found, F.col(f"_1_{v}")).otherwise(F.col(f"_2_{v}")).alias(v) for v in values]
    if tier:
        out.append(F.coalesce("_hit1", "_hit2").alias(tier))
    return joined.select(*df.columns, *out)


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str, bounded_by: Sequence[DataFrame] | int = ()
) -> DataFrame:
    """Overlapping or touching intervals of one key joined into one."""
    valid = df.filter(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    hot = hot_groups(df, keys, bounded_by)
    reached = over_ordered(valid, keys, [start], [Running("_reach", F.col(end), "max", strict=True)], hot=hot)
    opens = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    marked = reached.withColumn("_opens", opens)
    numbered = over_ordered(marked, keys, [start], [Running("_island", F.col("_opens"), "sum")], hot=hot)
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def _interval_ends(spans: DataFrame, columns: Sequence[str], at: str, start: str, end: str, signs: tuple[int, int]) -> DataFrame:
    """Two rows per interval: its start (``_kind`` 0, before the events of that
    time) and its end (``_kind`` 2, after them), each with its sign."""
    def edge(time, kind, sign):
        return F.struct(F.col(time).alias("t"), F.lit(kind).alias("k"), F.lit(sign).cast("long").alias("s"))

    both = F.array(edge(start, 0, signs[0]), edge(end, 2, signs[1]))
    return spans.select(*columns, F.explode(both).alias("_x")).select(
        *columns, F.col("_x.t").alias(at), F.col("_x.k").alias("_kind"), F.col("_x.s").alias("_sign")
    )


def inside_any_interval(
    events: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    alias: str = "inside",
    bounded_by: Sequence[DataFrame] | int = (),
) -> DataFrame:
    """1/0 flag: the event falls into an interval of its key, ends included.

    Starts, events and ends are swept in time order and the open intervals are
    a running sum, so the work grows with the inputs and never with the pairs
    of events and intervals.
    """
    ends = _interval_ends(intervals.filter(F.col(start) <= F.col(end)), keys, at, start, end, (1, -1))
    edges = ends.groupBy(*keys, at, "_kind").agg(F.sum("_sign").alias("_delta"))
    marked = events.withColumn("_delta", F.lit(0).cast("long")).withColumn("_kind", F.lit(1))
    swept = over_ordered(
        union_all(marked, edges),
        keys,
        [at, "_kind"],
        [Running("_open", F.col("_delta"), "sum")],
        bounded_by=bounded_by,
    )
    return swept.filter("_kind = 1").select(*events.columns, (F.col("_open") > 0).cast("int").alias(alias))


def totals_inside(
    events: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    owner: Sequence[str],
    at: str,
    start: str,
    end: str,
    measures: Sequence[str],
    bounded_by: Sequence[DataFrame] | int = (),
    merged: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Sums of event measures inside each owner's intervals, per (keys, owner).

    Starts and ends are put among the events in time order; running sums read
    at an end minus those read at its start are added up per owner. There is
    no join and no event is paired with an interval, however many owners share
    the same events. ``merged`` says that an owner's intervals are disjoint
    already; ``parts`` deals the sweep to so many tasks, whatever its bytes.
    """
    spans = intervals if merged else merge_intervals(intervals, [*keys, *owner], start, end, bounded_by)
    ends = _interval_ends(spans, [*keys, *owner], at, start, end, (-1, 1))
    per_time = events.groupBy(*keys, at).agg(*[F.sum(m).alias(m) for m in measures]).withColumn("_kind", F.lit(1))
    running = [Running(f"_s_{m}", F.coalesce(F.col(m), F.lit(0)), "sum") for m in measures]
    line = union_all(per_time, ends)
    line = line.repartition(parts, *keys) if parts else line
    swept = over_ordered(line, keys, [at, "_kind"], running, bounded_by=bounded_by)
    return swept.filter("_kind <> 1").groupBy(*keys, *owner).agg(
        *[F.sum(F.col(f"_s_{m}") * F.col("_sign")).alias(m) for m in measures]
    )


def first_within_tolerance(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    event_order: str,
    value: str,
    tolerance: int,
    alias: str,
    default=None,
    span: int = 64,
) -> DataFrame:
    """For each point the value of the first event (lowest ``event_order``) with
    |event time − point time| < ``tolerance``; times are whole units.

    Events and points are first reduced to one row per time unit. The time line
    is cut into blocks of ``span`` tolerances, rows near a cut are copied to the
    neighbouring block, and a range frame inside each block finds the first
    event: no point is paired with its events, and a block has a fixed length
    however crowded its key is.
    """
    reach = tolerance - 1
    first = F.struct(F.col(event_order).alias("o"), F.col(value).alias("v"))
    offered = events.groupBy(*keys, F.col(at).cast("long").alias("_t")).agg(F.min(first).alias("_e"))
    asked = points.select(*keys, F.col(at).cast("long").alias("_t"), F.lit(1).alias("_p")).distinct()
    line = union_all(offered, asked).groupBy(*keys, "_t").agg(F.min("_e").alias("_e"), F.max("_p").alias("_p"))

    def block(t):
        return F.floor(t / (span * tolerance))

    t = F.col("_t")
    copied = line.withColumn("_b", F.explode(F.array_distinct(F.array(block(t - reach), block(t), block(t + reach)))))
    window = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(-reach, reach)
    found = copied.select(*keys, "_t", "_b", "_p", F.min("_e").over(window).alias("_hit"))
    found = found.filter((F.col("_p") == 1) & (F.col("_b") == block(t))).select(*keys, "_t", "_hit")
    joined = null_safe_join(points.withColumn("_t", F.col(at).cast("long")), found, [*keys, "_t"], "left")
    return joined.select(*points.columns, F.coalesce(F.col("_hit.v"), F.lit(default)).alias(alias))


def nearest_date(
    df: DataFrame,
    candidates: DataFrame,
    pair: Sequence[str],
    date: str,
    candidate_date: str,
    values: Sequence[str] = (),
    alias: str = "nearest_date",
) -> DataFrame:
    """Each row with the candidate date of its pair that is closest to its own
    date; the earlier one on a tie; null when the pair has no candidate.

    The last candidate at or before and the first at or after each date are
    found by one sweep in each direction instead of pairing rows with all
    candidates. A pair holds at most two sweep rows per calendar date, so its
    window stays small. ``values`` come from the first candidate of the date.
    """
    wanted = df.select(*pair, F.to_date(F.col(date)).alias("_d")).distinct()
    payload = F.struct(F.to_date(F.col(candidate_date)).alias("c"), *values)
    offered = candidates.select(*pair, payload.alias("_c")).groupBy(*pair, F.col("_c.c").alias("_d")).agg(
        F.min("_c").alias("_c")
    )
    line = union_all(wanted.withColumn("_kind", F.lit(1)), offered.withColumn("_kind", F.lit(0)))
    back = over_ordered(line, pair, ["_d", "_kind"], [Running("_before", F.col("_c"), "last")], hot=None)
    both = over_ordered(
        back, pair, [F.col("_d").desc_nulls_last(), F.col("_kind").asc()], [Running("_after", F.col("_c"), "last")], hot=None
    ).filter("_kind = 1")
    gap_before, gap_after = F.datediff("_d", "_before.c"), F.datediff("_after.c", "_d")
    best = (
        F.when(F.col("_before").isNull(), F.col("_after"))
        .when(F.col("_after").isNull(), F.col("_before"))
        .when(gap_before <= gap_after, F.col("_before"))
        .otherwise(F.col("_after"))
    )
    found = both.select(*pair, "_d", best.alias("_best"))
    joined = null_safe_join(df.withColumn("_d", F.to_date(F.col(date))), found, [*pair, "_d"], "left")
    return joined.select(*df.columns, F.col("_best.c").alias(alias), *[F.col(f"_best.{v}").alias(v) for v in values])


def left_join_bounded(left: DataFrame, right: DataFrame, on: Sequence[str], bound: Column) -> DataFrame:
    """Left join with a bound on the right rows in the join condition: left rows
    whose matches all lie outside the bound stay, with nulls."""
    return left_join_many(left, right.filter(bound), on)


def with_scalar(df: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row, as scalar
    subqueries: evaluated once, joined with nothing."""
    return df.select("*", *[aggregates.select(c).scalar().alias(c) for c in aggregates.columns])


def reconcile(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], column: str, tolerance: float = 0.005) -> DataFrame:
    """Stored value against its recomputation: MATCH, DIFFERENT, MISSING_STORED,
    MISSING_SOURCE or BOTH_NULL for each key of the stored table."""
    again = recomputed.select(*keys, F.col(column).alias("_again"))
    both = null_safe_join(stored.select(*keys, F.col(column).alias("_stored")), again, keys, "left")
    s, r = F.col("_stored"), F.col("_again")
    verdict = (
        F.when(s.isNull() & r.isNull(), "BOTH_NULL")
        .when(s.isNull(), "MISSING_STORED")
        .when(r.isNull(), "MISSING_SOURCE")
        .when(F.abs(s - r) <= tolerance, "MATCH")
        .otherwise("DIFFERENT")
    )
    return both.select(*keys, s.alias(f"stored_{column}"), r.alias(f"source_{column}"), verdict.alias("verdict"))
