"""Drop lines that repeat an earlier line, exactly or but for one word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.words import SPACES, null_safe, text_key
from formline.session import reliable_checkpoint

LINE = ["__a", "__b"]
PLACE = ["__none", "__id", "__key", "__no"]
#: Candidate lines, of a few numbers each, that may be sent to every task.
BROADCAST_LINES = 1_000_000


def normal_line(line: Column) -> Column:
    """The line's words joined by single spaces; the regular expression runs only where there is something to mend."""
    odd = F.lit(False)
    for c in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, SPACES, " ")).otherwise(line))


def half_keys(words: str = "__w", line: str = "__s") -> list[Column]:
    """Four hashes of which any two lines one word apart share one.

    If lines of W words differ in one word, either the first or the last half is
    the same; if one has a word more, the shorter one's halves say so in the longer
    one as well. So a line gives its halves for its own length (places 0 and 1)
    and for the length below (2 and 3).
    """
    keys = []
    for base in (f"{words}", f"({words} - 1)"):
        keys.append(F.expr(f"xxhash64('first', {base}, substring_index({line}, ' ', CAST({base} DIV 2 AS INT)))"))
        keys.append(F.expr(f"xxhash64('last', {base}, substring_index({line}, ' ', CAST({base} DIV 2 - {base} AS INT)))"))
    return keys


def one_word_apart(x: str, y: str) -> Column:
    """Whether two normal lines differ by one word put in, taken out or replaced, at most."""
    first, second = F.split(x, " "), F.split(y, " ")
    a, b = F.size(first), F.size(second)
    at = F.array_position(F.zip_with(first, second, lambda u, v: u.eqNullSafe(v)), False).cast("int")
    rest = lambda words, skip: F.slice(words, at + 1 - skip, F.greatest(F.size(words) - at + skip, F.lit(0)))
    return (
        F.when(F.abs(a - b) > 1, False).when(at == 0, True)
        .when(a == b, rest(first, 0) == rest(second, 0))
        .when(a > b, rest(first, 0) == rest(second, 1))
        .otherwise(rest(first, 1) == rest(second, 0))
    )


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8, carry: tuple = ()) -> DataFrame:
    """One row per document: ``id, text_key, n_lines, n_dropped, clean_text`` and, as a struct ``carried``, the columns named by ``carry``.

    Lines end at line feeds and are compared as words joined by single spaces;
    lines without words stay. A line is dropped when the same line, or, from
    ``min_words`` words on, a line within one word put in, taken out or replaced,
    stands earlier: in a document with a smaller id, or above in the same
    document. Ids come in their order, null last, then a hash of the text. It makes
    no difference whether the earlier line is dropped itself.

    Equal lines are one row with their first place from the start. Lines sharing
    no half with another line can have no partner. The others emit a key for each
    word of the other half taken out (a running exclusive-or of hashes of word and
    place, so work is linear in a line's length). Equal keys are joined with the earliest line that
    has the key, never line with line, and such pairs are verified on the words.

    Null texts have no lines and a null clean_text. Rows that repeat id and text
    are one document and get the same result. No rows give no rows.
    """
    own = docs.select(F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__key"), F.col(text_col).alias("__text"))
    full = docs.select(
        F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__key"), F.col(text_col).alias("__text"), F.struct(*carry).alias("__carried")
    ) if carry else own
    lines = own.select("__id", "__key", F.posexplode(F.split("__text", "\n", -1)).alias("__no", "__line")).select(
        F.col("__id").isNull().alias("__none"), "__id", "__key", "__no", normal_line(F.col("__line")).alias("__s")
    ).filter("__s <> ''").withColumn("__w", F.size(F.split("__s", " ")))
    halves = [F.when(F.col("__w") >= min_words, k).alias(f"__h{i}") for i, k in enumerate(half_keys())]
    named = lines.select(
        F.xxhash64("__s").alias("__a"), F.xxhash64("__s", F.lit("b")).alias("__b"), F.struct(*PLACE).alias("__at"), F.struct(*halves).alias("__h")
    )
    distinct = reliable_checkpoint(
        named.groupBy(*LINE).agg(F.min("__at").alias("__at"), F.any_value("__h").alias("__h"))
        .select("__a", "__at.__id", "__at.__key", "__at.__no", "__h.*")
    )
    return _cleaned(full, distinct, _superseded(_candidates(own, distinct)), id_col)


def _candidates(own: DataFrame, distinct: DataFrame) -> DataFrame:
    """Lines that share a half with another, with their first places, texts and a mask of the halves shared.

    The few documents that hold them are found by a broadcast join as long as
    their lines are counted and below BROADCAST_LINES, else by a shuffle.
    """
    halves = distinct.select("__a", F.posexplode(F.array("__h0", "__h1", "__h2", "__h3")).alias("__i", "__half")).filter("__half is not null")
    shared = halves.groupBy("__half").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    open_ = reliable_checkpoint(
        halves.join(shared, "__half").groupBy("__a").agg(F.bit_or(F.expr("shiftleft(1, __i)")).alias("__mask"))
    )
    sized = F.broadcast if open_.count() <= BROADCAST_LINES else lambda df: df
    wanted = reliable_checkpoint(
        distinct.select("__a", "__id", "__key", "__no").join(sized(open_), "__a")
        .groupBy("__id", "__key").agg(F.collect_list(F.struct("__no", "__mask")).alias("__want"))
    )
    texts = null_safe(own, sized(wanted), ["__id", "__key"], "inner").select(
        "__id", "__key", "__want", F.split("__text", "\n", -1).alias("__lines")
    )
    picked = F.transform("__want", lambda x: F.struct(x["__no"].alias("no"), x["__mask"].alias("mask"), F.element_at("__lines", x["__no"] + 1).alias("line")))
    return reliable_checkpoint(
        texts.select("__id", "__key", F.explode(picked).alias("__x")).select(
            F.col("__id").isNull().alias("__none"), "__id", "__key", F.col("__x.no").alias("__no"), F.col("__x.mask").alias("__mask"),
            normal_line(F.col("__x.line")).alias("__s"),
        ).withColumns({"__a": F.xxhash64("__s"), "__b": F.xxhash64("__s", F.lit("b"))}).dropDuplicates(LINE)
    )


def _words(near: DataFrame) -> DataFrame:
    """A row for each word of a line. Lines are split and counted once, below the step that gives the rows."""
    split = near.select(*LINE, "__mask", F.split("__s", " ").alias("__words")).withColumn("__w", F.size("__words"))
    return split.select(*LINE, "__mask", "__w", F.posexplode("__words").alias("__p", "__word"))


def _superseded(near: DataFrame) -> DataFrame:
    """Of candidate lines, the places of those that an earlier one is a word apart from."""
    words = _words(near)
    whole = Window.partitionBy(*LINE)
    before = whole.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    here, moved = F.xxhash64("__word", "__p"), F.xxhash64("__word", F.col("__p") - 1)
    runs = words.withColumn("__here", here).withColumn("__moved", moved).select(
        *LINE, "__mask", "__w", "__p",
        F.coalesce(F.bit_xor("__here").over(before), F.lit(0)).bitwiseXOR(
            F.bit_xor("__moved").over(whole).bitwiseXOR(F.coalesce(F.bit_xor("__moved").over(before), F.lit(0))).bitwiseXOR(F.col("__moved"))
        ).alias("__less"),
        F.bit_xor("__here").over(whole).alias("__all"),
    )
    # A shared first half leaves the change to the words behind it, a shared last half to those before it.
    shares = lambda i: F.col("__mask").bitwiseAND(1 << i) != 0
    half = F.expr("__w DIV 2")
    below = F.expr("(__w - 1) DIV 2")
    inside = lambda i, edge: (shares(i) & (F.col("__p") >= edge)) | (shares(i + 1) & (F.col("__p") <= edge))
    kinds = F.array(
        F.when(inside(0, half), F.struct(F.xxhash64(F.lit("replaced"), "__w", "__p", "__less").alias("key"), F.lit(0).alias("side"))),
        F.when(inside(2, below), F.struct(F.xxhash64(F.lit("put in"), F.col("__w") - 1, "__less").alias("key"), F.lit(1).alias("side"))),
        F.when(F.col("__p") == 0, F.struct(F.xxhash64(F.lit("put in"), "__w", "__all").alias("key"), F.lit(2).alias("side"))),
    )
    keys = runs.select(*LINE, F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("__k")).select(*LINE, "__k.key", "__k.side")
    often = keys.groupBy("key").agg(F.min("__a").alias("__x"), F.max("__a").alias("__y")).filter("__x <> __y").select("key")
    found = reliable_checkpoint(keys.join(often, "key").join(near.select(*LINE, *PLACE), LINE))
    # Replaced words meet on one side; a line with a word more meets the whole line, and the other way round.
    first = found.groupBy("key", "side").agg(F.min(F.struct(*PLACE, *LINE)).alias("__first"))
    partner = first.select("key", F.when(F.col("side") == 0, 0).otherwise(3 - F.col("side")).alias("side"), "__first")
    pairs = (
        found.join(partner, ["key", "side"]).filter(F.col("__first") < F.struct(*PLACE, *LINE))
        .select(*LINE, F.col("__first.__a").alias("__c"), F.col("__first.__b").alias("__d")).distinct()
    )
    verified = pairs.join(near.select(*LINE, "__id", "__key", "__no", "__s"), LINE).join(
        near.select(F.col("__a").alias("__c"), F.col("__b").alias("__d"), F.col("__s").alias("__t")), ["__c", "__d"]
    )
    return verified.filter(one_word_apart("__s", "__t")).select("__id", "__key", "__no").distinct()


def _cleaned(own: DataFrame, distinct: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The documents with the first places of the lines that stay, and their blank lines."""
    keys = ["__id", "__key"]
    first = distinct.groupBy(*keys).agg(F.collect_list("__no").alias("__first"))
    late = gone.groupBy(*keys).agg(F.collect_list("__no").alias("__gone"))
    joined = null_safe(null_safe(own, first, keys, "left"), late, keys, "left").withColumn("__lines", F.split("__text", "\n", -1))
    none = F.array().cast("array<int>")
    blank = F.filter(
        F.transform("__lines", lambda line, i: F.when(F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) == "", i)), lambda i: i.isNotNull()
    )
    stay = F.array_except(F.coalesce("__first", none), F.coalesce("__gone", none))
    joined = joined.withColumn("__kept", F.array_sort(F.concat(stay, blank)))
    return joined.select(
        F.col("__id").alias(id_col), F.col("__key").alias("text_key"),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__text").isNull(), 0).otherwise(F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
        F.array_join(F.transform("__kept", lambda i: F.element_at("__lines", i + 1)), "\n").alias("clean_text"),
        *([F.col("__carried").alias("carried")] if "__carried" in own.columns else []),
    )


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8) -> DataFrame:
    """The documents, all columns, with their clean texts. Documents that lose every line they had words in are left out."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    cleaned = duplicate_lines(docs, id_col, text_col, min_words, tuple(others))
    left = (F.col("n_dropped") == 0) | (F.trim(F.translate("clean_text", "\t\r\n\x0b\x0c", "     ")) != "")
    named = {id_col: F.col(id_col), text_col: F.col("clean_text")} | {c: F.col("carried")[c] for c in others}
    return cleaned.filter(left).select(*[named[c].alias(c) for c in docs.columns])
