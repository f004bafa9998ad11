"""Runs of words as 64-bit hashes: tables of counts that grow with the corpus, and asking them.

A run is one to three words in a row, lower-cased, whatever stands between them;
the last two bits of its hash say how many.
Tables stay in Spark. What a task holds of one is a filter of bits: runs that
aren't in the table are rarely asked for, and no run of the table is missed. A
full filter lets more runs pass to the join; results are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.words import hash_runs, hash_words, split_words, text_slices

LONGEST = 3
FILTER_BITS = 1 << 28


class Filter:
    """One bit for the last bits of each run in a table."""

    def __init__(self, table: DataFrame):
        import numpy as np

        self.size = 1 << 10
        most = 16 * table.count()
        while self.size < min(most, FILTER_BITS):
            self.size *= 2
        place = F.pmod("run", F.lit(self.size))
        words = table.select(
            F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(run & 63 as int))").alias("bit")
        ).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.bits = np.zeros(self.size // 64, np.uint64)
        self.bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)

    def may_have(self, runs):
        import numpy as np

        at = runs & np.uint64(self.size - 1)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) > 0


def words_of(texts):
    """``(hashes, last, row, words)``: all words of an Arrow array of texts, the end of each word's text, its text, and each text's number of words."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\pL\pM\pN]+", " ")
    words, offsets = split_words(plain)
    n = np.diff(offsets)
    return hash_words(words, ("formline-words-r",))[0], np.repeat(offsets[1:], n), np.repeat(np.arange(len(n)), n), n


def runs_of(texts, some: Filter | None = None):
    """``(rows, runs, words)`` of an Arrow array of texts: the distinct runs of each text that ``some`` may have, and each text's words."""
    import numpy as np

    hashes, last, row, n = words_of(texts)
    rows, runs = [], []
    for k in range(1, LONGEST + 1):
        found = hash_runs(hashes, k) & ~np.uint64(3) | np.uint64(k)  # the last two bits say how many words
        good = np.arange(len(found)) + k <= last[: len(found)]
        if some is not None:
            good &= some.may_have(found)
        rows.append(row[: len(found)][good])
        runs.append(found[good])
    rows, runs = np.concatenate(rows), np.concatenate(runs)
    order = np.lexsort((runs, rows))
    rows, runs = rows[order], runs[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (runs[1:] != runs[:-1])
    return rows[first], runs[first], n


def count_runs(texts: DataFrame, some: Filter | None = None) -> DataFrame:
    """``run, n``: how many texts hold it, over whole texts of the column ``text``; slices and tasks combine their counts."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_slices(batches):
            distinct, n = np.unique(runs_of(batch["text"], some)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n.astype(np.int64))], ["run", "n"])

    return texts.select("text").mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))


REGISTERS = 1 << 12


def _registers(runs):
    """Place and rank of each run in a sketch of distinct values: leading zeros behind the first twelve bits."""
    import numpy as np

    rest = (runs & np.uint64((1 << 52) - 1)) >> np.uint64(2)
    return (runs >> np.uint64(52)).astype(np.int64), 51 - np.frexp(rest.astype(float))[1]


def distinct_estimate(ranks) -> float:
    """How many distinct values left these ranks, within some 2 %."""
    import numpy as np

    m = len(ranks)
    empty = np.count_nonzero(np.asarray(ranks) == 0)
    estimate = 0.7213 / (1 + 1.079 / m) * m * m / np.exp2(-np.asarray(ranks, float)).sum()
    return m * np.log(m / empty) if estimate < 2.5 * m and empty else estimate


def run_totals(texts: DataFrame):
    """``(n, distinct)`` per length: texts' distinct runs added up, and the estimated number of distinct runs.

    All texts of the column ``text`` count; the driver gets one number per register of a sketch and length.
    """
    import numpy as np

    def sketch(batches):
        import pyarrow as pa

        ranks, n = np.zeros((LONGEST, REGISTERS), np.int32), np.zeros((LONGEST, REGISTERS), np.int64)
        for batch in text_slices(batches):
            runs = runs_of(batch["text"])[1]
            size = (runs & np.uint64(3)).astype(np.int64) - 1
            place, rank = _registers(runs)
            np.maximum.at(ranks, (size, place), rank)
            n[:, 0] += np.bincount(size, minlength=LONGEST)
        cell = np.flatnonzero((ranks > 0) | (n > 0))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ranks.ravel()[cell]), pa.array(n.ravel()[cell])], ["cell", "rank", "n"])

    found = texts.select("text").mapInArrow(sketch, "cell long, rank int, n long").groupBy("cell").agg(F.max("rank").alias("rank"), F.sum("n").alias("n")).toArrow()
    ranks, n = np.zeros(LONGEST * REGISTERS, np.int32), np.zeros(LONGEST * REGISTERS, np.int64)
    ranks[found["cell"].to_numpy()], n[found["cell"].to_numpy()] = found["rank"].to_numpy(), found["n"].to_numpy()
    return n.reshape(LONGEST, -1).sum(axis=1), [float(distinct_estimate(r)) for r in ranks.reshape(LONGEST, -1)]


def parts_of(texts: DataFrame, some: Filter) -> DataFrame:
    """``run, head, w1, w2, w3``: the runs of two or three words that ``some`` may have, without their last word, and word by word (0: none)."""
    names = ["run", "head", "w1", "w2", "w3"]

    def split(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_slices(batches):
            hashes, last = words_of(batch["text"])[:2]
            seen = [hash_runs(hashes, k) & ~np.uint64(3) | np.uint64(k) for k in range(1, LONGEST + 1)]
            for k in range(2, LONGEST + 1):
                run = seen[k - 1]
                at = np.flatnonzero((np.arange(len(run)) + k <= last[: len(run)]) & some.may_have(run))
                at = at[np.unique(run[at], return_index=True)[1]]
                words = [seen[0][at + i] if i < k else np.zeros(len(at), np.uint64) for i in range(LONGEST)]
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (run[at], seen[k - 2][at], *words)], names)

    found = texts.select("text").mapInArrow(split, ", ".join(f"{c} long" for c in names))
    return found.groupBy("run").agg(*[F.min(c).alias(c) for c in names[1:]])
