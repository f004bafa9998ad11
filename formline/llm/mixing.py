"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.words import null_safe, text_key, word_count
from formline.session import reliable_checkpoint

WEIGHTS = (3, 1, 2)


def source_targets(
    totals: DataFrame, source: str = "source", size: str = "source_size", weights=WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Adds ``target``: what the mix should take of each source.

    Weights go round over the sources in code point order, null last. Targets
    share ``share`` times all sizes by weight; none is above ``most`` times its
    source's size, and what is cut off is shared out again by weight among the
    others until none is above. That fixed point has a closed form: with the
    sources in order of size / weight, the first k are at their bound and the rest
    get weight times one level. ``totals`` has one row per source; only these few
    rows meet in one task.
    """
    ordered = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    bound = F.col(size) * F.lit(float(most))
    by_fill = Window.orderBy((bound / F.col("__w")).asc(), F.col(source).asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("__all") * F.lit(float(share)) - F.coalesce(F.sum(bound).over(before), F.lit(0.0))) / (
        F.col("__all_w") - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    )
    return (
        totals.withColumn("__w", weight)
        .withColumn("__all", F.sum(size).over(everything).cast("double"))
        .withColumn("__all_w", F.sum("__w").over(everything))
        .withColumn("__k", F.row_number().over(by_fill))
        .withColumn("__level", level)
        .withColumn("__fits", F.when(F.col("__level") * F.col("__w") <= bound, F.col("__level")))
        .withColumn("__at", F.min(F.struct(F.col("__fits").isNull().alias("no"), "__k", "__fits")).over(everything)["__fits"])
        .withColumn("target", F.least(bound, F.coalesce(F.col("__at") * F.col("__w"), bound)))
        .drop("__w", "__all", "__all_w", "__k", "__level", "__fits", "__at")
    )


def offset_of(source: Column, seed: str) -> Column:
    """One number from [0, 1) per source: the first 32 bits of an MD5 of seed and source."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\x00"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_plan(
    sized: DataFrame, keys: list[str], source: str = "source", size: str = "size", weights=WEIGHTS, share: float = 1.5,
    most: float = 2.0, seed: str = "mix",
) -> DataFrame:
    """How often the mix takes each row: ``keys, source, size, source_size, target, copies``.

    Every row of a source expects target / source_size copies. Rows stand in
    order of size and keys, the expectations are added up along that order, one
    offset per source is added, and a row is taken once for each whole number its
    step crosses. Neighbours have like sizes, so the words taken keep close to the
    target, and no row is taken more than ``most`` times, rounded up. The same
    rows and seed give the same mix.

    A source may hold any share of the rows: rows are range partitioned by
    (source, size, keys) into blocks, frozen by a checkpoint (narrow rows, no
    texts), numbered inside their block and moved on by the counts of the blocks
    before. Sources of size 0 have target 0 and rows of theirs are not taken.
    """
    order = [source, size, *keys]
    blocks = reliable_checkpoint(
        sized.select(*keys, source, size).repartitionByRange(*order).withColumn("__block", F.spark_partition_id())
    )
    counts = blocks.groupBy(source, "__block").agg(F.count(F.lit(1)).alias("__n"), F.sum(size).alias("__size"))
    totals = counts.groupBy(source).agg(F.sum("__size").alias("source_size"))
    targets = source_targets(totals, source, "source_size", weights, share, most)
    before = Window.partitionBy(source).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = null_safe(
        counts.select(source, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), targets, [source], "inner"
    )
    inside = Window.partitionBy(source, "__block").orderBy(size, *keys)
    ranked = null_safe(blocks.withColumn("__rank", F.row_number().over(inside)), starts, [source, "__block"], "inner")
    per_row = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("__start") + F.col("__rank")).cast("double")
    step = F.col("__offset")
    copies = F.floor(rank * F.col("__per") + step) - F.floor((rank - 1) * F.col("__per") + step)
    return (
        ranked.withColumn("__per", per_row)
        .withColumn("__offset", offset_of(F.col(source), seed))
        .select(*keys, source, size, "source_size", "target", copies.cast("long").alias("copies"))
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents, all columns, once for each copy that the mix takes, with the number of the copy in ``copy``.

    Sizes are numbers of words. Rows that repeat id and text are one document that
    is taken as often as all of them together. Documents not taken are
    left out. A column ``copy`` of the input is replaced.
    """
    keyed = docs.withColumn("__id", F.col(id_col)).withColumn("__key", text_key(F.col(text_col)))
    plan = mix_plan(keyed.select("__id", "__key", F.col(source).alias("__source"), word_count(F.col(text_col)).alias("__size")),
                    ["__id", "__key"], "__source", "__size", **options)
    # Rows that are equal in id and text become one row with all their copies.
    copies = plan.groupBy("__id", "__key").agg(F.sum("copies").alias("__copies")).filter("__copies > 0")
    one = keyed.dropDuplicates(["__id", "__key"])
    out = null_safe(one, copies, ["__id", "__key"], "inner").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return out.select(*[c for c in docs.columns if c != "copy"], "copy")
