"""Collocations: phrases that occur more often than their parts explain, counted in suffix subtrees.

Every word begins a suffix of its piece, cut off after as many words as a phrase may
have. The suffixes are partitioned vertically, by their first two words: a first
scan counts them in 2^18 classes of such prefixes, neighbouring classes are put
together to groups up to a budget of suffixes, and a class beyond the budget is
extended by its third word. A second scan sends each slice's distinct suffixes to
their group, with counts. Each group then builds its own depth-truncated subtree,
sorted suffixes with their totals as leaves, and a phrase's count is the sum of the
leaves below it. Phrases above an extended class add up over its groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.scratch import Scratch
from formline.llm.words import hash_words, text_slices

FIRST_BITS, SECOND_BITS = 12, 6
CLASSES = 1 << FIRST_BITS + SECOND_BITS
BREAKS = b".,;:!?\n\v\f\r"
SPACES = b" \t"
MESSAGE = "group int, extended boolean, lang string, suffixes binary"
NODE = "lang string, phrase string, words int, n long"


def piece_words(data, offsets):
    """``(words, follows)`` of UTF-8 bytes: the words in lower case (A-Z), and whether each goes on the piece of the one before it."""
    import numpy as np
    import pyarrow as pa

    n = len(data)
    kind = np.zeros(256, np.uint8)
    kind[list(SPACES)], kind[list(BREAKS)] = 1, 2
    kinds = kind[data]
    real = kinds == 0
    start = real.copy()
    start[1:] &= ~real[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    start[firsts] = real[firsts]
    begins = np.flatnonzero(start)
    if not len(begins):
        return pa.array([], pa.binary()), np.zeros(0, bool)
    breaks = np.cumsum(kinds == 2, dtype=np.int32)[begins]
    text = np.searchsorted(offsets, begins, side="right")
    follows = np.zeros(len(begins), bool)
    follows[1:] = (breaks[1:] == breaks[:-1]) & (text[1:] == text[:-1])
    before = np.cumsum(real, dtype=np.int32)
    ends = np.append(before[begins] - 1, before[-1]).astype(np.int32)
    lower = data[np.flatnonzero(real)]
    lower = np.where((lower >= 0x41) & (lower <= 0x5A), lower + np.uint8(0x20), lower)
    return pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(lower)]), follows


class Suffixes:
    """The suffixes that begin in some texts of one language: a row of word codes each (0: the piece has ended), and the words."""

    def __init__(self, texts, lang: str, depth: int):
        import zlib

        import numpy as np
        import pyarrow as pa

        raw = texts.cast(pa.large_string())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        words, follows = piece_words(data, offsets - offsets[0])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.columns = [coded.indices.to_numpy().astype(np.int64) + 1]
        for _ in range(depth - 1):
            after = np.zeros(len(words), np.int64)
            after[:-1] = np.where(follows[1:], self.columns[-1][1:], 0)
            self.columns.append(after)
        self.hashes = np.concatenate([np.zeros(1, np.uint64), hash_words(self.words.cast(pa.string()), ("formline-phrases",))[0]])
        self.salt = np.uint64(zlib.crc32(lang.encode()) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)

    def classes(self, columns):
        """The prefix class of each suffix: high bits by the first word, low bits by the second."""
        import numpy as np

        first = (self.hashes ^ self.salt) >> np.uint64(64 - FIRST_BITS)
        second = (self.hashes + self.salt) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - SECOND_BITS)
        return (first[columns[0]] << np.uint64(SECOND_BITS) | second[columns[1]]).astype(np.int64)


def sorted_leaves(columns, counts=None):
    """``(columns, totals)``: the distinct suffixes in order, and how often each occurs."""
    import numpy as np

    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    bits = max(1, int(max(c.max() for c in columns)).bit_length())
    key, used = columns[0], bits
    for c in columns[1:]:
        if used + bits > 63:  # number what there is so far, in order, to make room
            key = np.unique(key, return_inverse=True)[1]
            used = max(1, int(key.max()).bit_length())
        key, used = key << bits | c, used + bits
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    totals = np.diff(np.append(first, len(key))) if counts is None else np.add.reduceat(counts[order], first)
    return [c[order[first]] for c in columns], totals


def packed(words, columns, totals) -> bytes:
    """Suffixes as bytes: their words once, narrow codes and counts, compressed."""
    import numpy as np
    import pyarrow as pa

    held = np.unique(np.concatenate(columns))
    held = held[held > 0]
    place = np.zeros(int(held[-1]) + 1 if len(held) else 1, np.int64)
    place[held] = np.arange(1, len(held) + 1)
    narrow = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
    arrays = [pa.array(narrow(place[c])) for c in columns] + [pa.array(narrow(totals))]
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for names, some in ((["w"], [words.take(pa.array(held - 1))]), ([f"c{i}" for i in range(len(arrays))], arrays)):
        batch = pa.RecordBatch.from_arrays(some, names)
        with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes):
    import pyarrow as pa

    source = pa.BufferReader(data)
    words = pa.ipc.open_stream(source).read_all()["w"].combine_chunks()
    rest = pa.ipc.open_stream(source).read_all()
    columns = [c.combine_chunks().to_numpy() for c in rest.columns]
    return words, columns[:-1], columns[-1]


def by_language(batches, size: int):
    """``(lang, texts)`` of slices."""
    import pyarrow.compute as pc

    for batch in text_slices(batches, size=size):
        for lang in batch["lang"].unique().to_pylist():
            yield lang, batch["text"].filter(pc.equal(batch["lang"], lang))


def group_classes(counts, budget: int):
    """``(groups, parts)`` for each class: neighbours together up to the budget; a class beyond it gets several groups of its own, one to each part."""
    import numpy as np

    groups, parts = np.zeros(CLASSES, np.int32), np.ones(CLASSES, np.int32)
    group, held = 0, 0
    for k, n in enumerate(counts.tolist()):
        if n > budget:
            parts[k] = -(-n // budget)
            group += held > 0
            groups[k], group, held = group, group + parts[k], 0
            continue
        if held + n > budget:
            group, held = group + 1, 0
        groups[k], held = group, held + n
    return groups, parts


def phrase_counts(docs: DataFrame, lang_col: str, text_col: str, depth: int, least: int, budget: int, slice_bytes: int) -> DataFrame:
    """``lang, phrase, words, n`` of all phrases of up to ``depth`` words with ``least`` occurrences; words 0 is the language's total."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches):
        import numpy as np
        import pyarrow as pa

        totals = np.zeros(CLASSES, np.int64)
        for lang, texts in by_language(batches, slice_bytes):
            suffixes = Suffixes(texts, lang, 2)
            totals += np.bincount(suffixes.classes(suffixes.columns), minlength=CLASSES)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(totals[held])], ["class", "n"])

    import numpy as np

    classes = rows.mapInArrow(count, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()  # 2^18 rows at most
    counts = np.zeros(CLASSES, np.int64)
    counts[classes["class"].to_numpy()] = classes["n"].to_numpy()
    shared = spark.sparkContext.broadcast(group_classes(counts, budget))

    def send(batches):
        import numpy as np
        import pyarrow as pa

        groups, parts = shared.value
        for lang, texts in by_language(batches, slice_bytes):
            suffixes = Suffixes(texts, lang, depth)
            columns, totals = sorted_leaves(suffixes.columns)
            if not len(totals):
                continue
            kinds = suffixes.classes(columns)
            rest = reduce(lambda h, c: h * np.uint64(31) + suffixes.hashes[c], columns[2:], np.zeros(len(totals), np.uint64))
            part = ((rest ^ rest >> np.uint64(32)) % parts[kinds].astype(np.uint64)).astype(np.int32)
            group = groups[kinds] + part
            order = np.argsort(group, kind="stable")
            group, extended = group[order], parts[kinds][order] > 1
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            for a, b in zip(first, [*first[1:], len(group)], strict=True):
                data = packed(suffixes.words, [c[order[a:b]] for c in columns], totals[order[a:b]])
                yield pa.RecordBatch.from_pydict({"group": pa.array([group[a]], pa.int32()), "extended": [bool(extended[a])], "lang": [lang], "suffixes": [data]})

    def tree(messages):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lang, extended = messages["lang"][0].as_py(), messages["extended"][0].as_py()
        columns, counts = [[] for _ in range(depth)], []
        parts = [unpacked(m) for m in messages["suffixes"].to_pylist()]
        coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
        words, codes, at = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64) + 1, 0
        for vocabulary, some, n in parts:
            place = np.concatenate([[0], codes[at : at + len(vocabulary)]])
            at += len(vocabulary)
            for held, c in zip(columns, some, strict=True):
                held.append(place[c])
            counts.append(n.astype(np.int64))
        del parts
        leaves, totals = sorted_leaves([np.concatenate(c) for c in columns], np.concatenate(counts))
        names, sizes, sums = [pa.array([""])], [np.zeros(1, np.int32)], [np.array([totals.sum()])]
        new = np.zeros(len(totals), bool)
        new[:1] = True
        for k, c in enumerate(leaves, 1):
            new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            n = np.add.reduceat(totals, first)
            keep = c[first] > 0
            if k == depth or k > 1 and not extended:  # counted here only
                keep &= n >= least
            first, n = first[keep], n[keep]
            parts = [words.take(pa.array(col[first] - 1)) for col in leaves[:k]]
            names.append(parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " "))
            sizes.append(np.full(len(n), k, np.int32))
            sums.append(n)
        phrases = pa.chunked_array(names, pa.string())
        return pa.table({"lang": pa.array([lang] * len(phrases), pa.string()), "phrase": phrases, "words": np.concatenate(sizes), "n": np.concatenate(sums)})

    nodes = rows.mapInArrow(send, MESSAGE).groupBy("group", "lang").applyInArrow(tree, NODE)
    return nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("words") == 0))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 3, least: int = 10, share: int = 50, top: int | None = 2000,
    budget: int = 4_000_000, slice_bytes: int = 8 << 20,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two to ``longest`` words of each language.

    Words are lower-cased (A-Z) and stand between spaces, tabs and the signs and
    line ends that end a piece; phrases lie in one piece. ``a`` counts all
    occurrences, ``least`` or more; cut after some word, the parts occur ``l`` and
    ``r`` times, and the cut with the lowest ``1000000 * a * a / (l * r)`` (floored,
    exact) counts, the first of equals. A phrase that lies in a longer candidate with
    at least ``share`` percent as many occurrences is left out. Ordered by score, a
    and phrase; ``top`` None returns all. ``n`` counts the language's words.

    Null texts are empty; a null language is ``und``; rows that repeat count each
    time. ``budget`` bounds the suffixes that a group's task holds (about 60 bytes
    each); a phrase on a third of all rows is one leaf from each slice.
    """
    folder = Scratch(docs.sparkSession, "phrases")
    nodes = folder.table(phrase_counts(docs, lang_col, text_col, longest, least, budget, slice_bytes))
    held = nodes.filter("words > 0").select("lang", "phrase", "n")
    candidates = nodes.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first, many):
        return F.array_join(F.slice("w", first, many), " ")

    k = F.col("k")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), k).alias("left"), part(k + 1, F.size("w") - k).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(held.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    cut = cut.withColumn("__up", (wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"))
    cut = cut.withColumn("__down", (wide["l"] * wide["r"]).cast("decimal(38,0)")).withColumn("score", F.expr("__up div __down"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))

    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("w") - 1),
        lambda many: F.transform(F.sequence(F.lit(1), F.size("w") - many + 1), lambda first: F.array_join(F.slice("w", first, many), " ")),
    ))
    inside = candidates.filter(F.size("w") > 2).select("lang", "a", F.explode(spans).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("__longer"))
    scored = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("__longer").isNull() | (100 * F.col("__longer") < share * F.col("a")))
    scored = scored.select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # a few windows a language first, so that none sorts all of its phrases
        few = scored.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(16)))
        at = F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))
        scored = few.withColumn("__at", at).filter(F.col("__at") <= top).drop("__at", "__salt")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    totals = nodes.filter("words = 0").select("lang", "n")  # a row a language
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
