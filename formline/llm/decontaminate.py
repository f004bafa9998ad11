"""Find and remove passages of benchmark items in training texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.scratch import Scratch
from formline.llm.words import ascii_lower, null_safe, text_key

#: What separates words once A-Z are lower-cased: ASCII other than 0-9 and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(col: Column) -> Column:
    """The normalised words of a text, in order; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(col, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def part(words: Column, start, length) -> Column:
    """``length`` words from position ``start`` (counted from 0), joined by spaces."""
    return F.array_join(F.slice(words, start + 1, length), " ")


def gram_length(window: int) -> int:
    """Any window of ``window`` words holds whole a gram of this length that starts at a multiple of it."""
    return (window + 1) // 2


def item_windows(items: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """``item, length, window`` for every n consecutive words; an item of fewer words is one window."""
    words = items.select(F.col(item_col).alias("__item"), item_words(F.col(text_col)).alias("__words")).filter(F.size("__words") > 0)
    length = F.least(F.lit(n), F.size("__words"))
    starts = words.select("__item", "__words", length.alias("__len"), F.explode(F.sequence(F.lit(0), F.size("__words") - length)).alias("__at"))
    return starts.select("__item", "__len", part(F.col("__words"), F.col("__at"), F.col("__len")).alias("__window")).distinct()


def gram_hash(window: int, gram: Column) -> Column:
    return F.xxhash64(F.lit(window), gram)


def _bind(function, size: int, g: int):
    """The function of one column that Spark's higher-order functions ask for."""

    def bound(at):
        return function(size, g, at)

    return bound


def _grams(windows: DataFrame, size: int) -> DataFrame:
    g = gram_length(size)
    words = F.split("__window", " ")
    inner = F.transform(F.sequence(F.lit(0), F.lit(g - 1)), lambda at: part(words, at, F.lit(g)))
    return windows.select(F.explode(inner).alias("__g")).select(gram_hash(size, F.col("__g")).alias("__gram"))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", n: int = 10, max_broadcast: int = 200_000, max_hits: int = 1_000_000,
) -> DataFrame:
    """One row per document with the words that windows of benchmark items cover.

    The windows' inner grams (5 words for windows of 10) form a hash set. Documents
    are looked up only at each fifth position, since any whole window holds such a
    gram at such a position: their aligned grams, 64 bits and no text, meet the set
    in a semi-join, to which the set is sent when it is counted as at most
    ``max_broadcast`` grams and shuffled beyond. The documents that hit, with the
    grams they hit, go back to the texts the same way (sent up to ``max_hits``
    grams, counted). There the windows around each hit are compared as text with
    the items' windows, so hashes alone decide nothing.

    Returns ``id, text_key, n_words, n_hit, spans`` (start and length of every
    occurrence), ``items`` (ids, distinct, sorted as strings). Null and empty
    texts have no words and no hits; items without words, or with a null id, hit
    no document's item list (words of an item with null id still count as hit).
    Repeated rows each get a row. No items: no hits.
    """
    spark = docs.sparkSession
    folder = Scratch(spark, "grams")
    windows = folder.table(item_windows(items, item_col, item_text, n))
    sizes = [r[0] for r in windows.select("__len").distinct().collect()]  # at most n values
    small = True

    texts = docs.select(
        F.monotonically_increasing_id().alias("__row"), F.col(id_col), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("__text")
    ).withColumn("__doc", F.xxhash64(id_col, "text_key"))
    split = item_words(F.col("__text")).alias("__words")
    words, total = F.col("__words"), F.size("__words")

    def aligned(size: int, g: int) -> Column:
        """``at, gram`` of each aligned gram, for windows of one size."""
        places = F.when(total >= size, F.sequence(F.lit(0), total - g, F.lit(g))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, _bind(lambda size, g, at: F.struct(at.alias("at"), gram_hash(size, part(words, at, F.lit(g))).alias("gram")), size, g))

    def around(size: int, g: int, at: Column) -> Column:
        """The windows for which the aligned gram at ``at`` is the first inside."""
        first, last = F.greatest(F.lit(0), at - (g - 1)), F.least(at, total - size)
        return F.when(
            first <= last,
            F.transform(F.sequence(first, last), lambda p: F.struct(p.alias("at"), F.lit(size).alias("len"), part(words, p, F.lit(size)).alias("window"))),
        ).otherwise(F.array().cast("array<struct<at:int,len:int,window:string>>"))

    found, base = F.array().cast("array<struct<at:int,len:int,window:string>>"), texts.select("__row", id_col, "text_key", split)
    if sizes:
        grams, each = None, F.array().cast("array<long>")
        for size in sizes:
            some = _grams(windows.filter(F.col("__len") == size), size)
            grams = some if grams is None else grams.unionByName(some)
            each = F.concat(each, F.transform(aligned(size, gram_length(size)), lambda x: x["gram"]))
        grams = folder.table(grams.distinct())
        small = grams.count() <= max_broadcast
        narrow = texts.select("__doc", split).select("__doc", F.explode(F.array_distinct(each)).alias("__gram"))
        met = narrow.join(F.broadcast(grams) if small else grams, "__gram", "left_semi")
        hits = folder.table(met.groupBy("__doc").agg(F.collect_set("__gram").alias("__hit")))
        few = (hits.agg(F.sum(F.size("__hit") + 2)).first()[0] or 0) <= max_hits
        base = texts.join(F.broadcast(hits) if few else hits, "__doc", "left").select("__row", id_col, "text_key", "__hit", split)
        for size in sizes:
            g = gram_length(size)
            hit = F.filter(F.when(F.col("__hit").isNotNull(), aligned(size, g)), lambda x: F.array_contains("__hit", x["gram"]))
            spots = F.flatten(F.transform(F.transform(hit, lambda x: x["at"]), _bind(around, size, g)))
            found = F.concat(found, F.coalesce(spots, F.array().cast("array<struct<at:int,len:int,window:string>>")))
    spots = base.select("__row", id_col, "text_key", total.cast("long").alias("n_words"), F.explode_outer(found).alias("__spot"))

    # Rows without a spot get a key of their own, so they don't meet in one task where the join is shuffled.
    key = F.coalesce(F.col("__spot.window"), F.concat(F.lit(" "), F.col("__row").cast("string")))
    table = windows.groupBy(F.col("__window").alias("__key")).agg(
        F.collect_set(F.col("__item").cast("string")).alias("__items"), F.lit(True).alias("__known")
    )
    joined = spots.withColumn("__key", key).join(F.broadcast(table) if small else table, "__key", "left")
    span = F.when(F.col("__known"), F.struct(F.col("__spot.at").alias("at"), F.col("__spot.len").alias("len")))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1))))
    return (
        joined.groupBy("__row", id_col, "text_key", "n_words")
        .agg(F.collect_set(span).alias("spans"), F.array_distinct(F.flatten(F.collect_set("__items"))).alias("items"))
        .select(
            id_col, "text_key", "n_words", F.size(covered).cast("long").alias("n_hit"),
            F.array_sort("spans").alias("spans"), F.array_sort("items").alias("items"),
        )
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_hits: int = 1, **options
) -> DataFrame:
    """The documents, all columns, with fewer than ``least_hits`` words inside benchmark windows."""
    hit = contamination(docs, items, id_col, text_col, **options).filter(F.col("n_hit") >= least_hits)
    keyed = docs.withColumn("__key", text_key(F.col(text_col)))
    bad = hit.select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct()
    return null_safe(keyed.withColumn("__id", F.col(id_col)), bad, ["__id", "__key"], "left_anti").drop("__key", "__id")
