"""Kneser-Ney models over runs of real code points, in sorted arrays of 64-bit hashes that grow with the corpus.

A symbol is a letter's lower-case code point or a combining mark's; whatever
stands between them is one space. A run of four symbols is counted exactly, its
first three packed into 63 bits. Orders below are continuation counts.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.words import text_slices

ORDER = 4
#: Where nothing is known: as likely as one of this many symbols.
ALPHABET = 1 << 17
MASKS = [0, (1 << 21) - 1, (1 << 42) - 1, (1 << 63) - 1]


@lru_cache(1)
def symbol_table():
    """The symbol of every code point; 0 between words."""
    import unicodedata

    import numpy as np

    out = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            out[point] = ord(c.lower()[0])
    return out


def grams(texts: list[str]):
    """``(contexts, symbols, ends)``: each symbol with the three before it, and where each text's begin and end."""
    import numpy as np

    joined = " " + " ".join(texts) + " "
    x = symbol_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    starts = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    keep = x != 0
    keep[1:] |= x[:-1] != 0
    before = np.concatenate([[0], np.cumsum(keep)])
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    text = np.concatenate([[-1], text])[: len(x)]
    x, text = x[keep].astype(np.int64), text[keep]
    context = np.zeros(len(x), np.int64)
    for k in (1, 2, 3):  # what stands in the text before is a space
        same = text[k:] == text[:-k]
        context[k:] |= np.where(same, x[:-k], 0) << 21 * (k - 1)
    return context, x, before[starts]


def hashed(context, symbol, order: int):
    """64 bits of the last ``order`` symbols."""
    import numpy as np

    x = (context & MASKS[order - 1]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(order)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + symbol.astype(np.uint64)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def distinct(context, symbol):
    """``(contexts, symbols, at)``: the distinct runs, and the place of each run among them."""
    import numpy as np
    import pandas as pd

    at, _ = pd.factorize(hashed(context, symbol, ORDER))
    first = np.full(at.max(initial=-1) + 1, -1)
    first[at[::-1]] = np.arange(len(at))[::-1]
    return context[first], symbol[first], at


def count_grams(texts: DataFrame, class_col: str, text_col: str) -> DataFrame:
    """``class, context, symbol, n`` over all rows and whole texts; slices and tasks combine their counts."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_slices(batches):
            by_class: dict[str, list[str]] = {}
            for name, text in zip(batch["class"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if name is not None and text:
                    by_class.setdefault(name, []).append(text)
            for name, some in by_class.items():
                context, symbol, ends = grams(some)
                context, symbol, at = distinct(context[ends[0] :], symbol[ends[0] :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(symbol), pa.string()), pa.array(context), pa.array(symbol), pa.array(np.bincount(at, minlength=len(symbol)).astype(np.int64))],
                    ["class", "context", "symbol", "n"],
                )

    rows = texts.select(F.col(class_col).cast("string").alias("class"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "class string, context long, symbol long, n long").groupBy("class", "context", "symbol").agg(F.sum("n").alias("n"))


class Model:
    """One language: per order the sorted hashes of its runs with log probabilities, and of its contexts with the weight of the order below."""

    def __init__(self, context, symbol, n):
        import numpy as np

        self.orders = []
        levels = [(context, symbol, n.astype(float))]
        for k in range(ORDER - 1, 0, -1):
            # Distinct longer runs that end in this one.
            c, s, _ = levels[-1]
            pair = np.stack([c & MASKS[k - 1], s])
            found, many = np.unique(pair, axis=1, return_counts=True)
            levels.append((found[0], found[1], many.astype(float)))
        for k, (c, s, m) in enumerate(reversed(levels), 1):
            once, twice = (m == 1).sum(), (m == 2).sum()
            discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
            held, of = np.unique(c, return_inverse=True)
            total, kinds = np.bincount(of, weights=m), np.bincount(of)
            weight = discount * kinds / total
            lower = np.exp(self.logs(c, s, k - 1))
            p = np.log((m - discount) / total[of] + weight[of] * lower)
            runs, contexts = hashed(c, s, k), hashed(held, np.zeros_like(held), k)
            a, b = np.argsort(runs), np.argsort(contexts)
            self.orders.append((runs[a], p[a].astype(np.float32), contexts[b], np.log(weight[b]).astype(np.float32)))

    def logs(self, context, symbol, order: int = ORDER):
        """The log probability of each symbol after its context; where a run isn't known, the order below, weighted as its context says."""
        import numpy as np

        out, open_ = np.zeros(len(symbol)), np.arange(len(symbol))
        for k in range(order, 0, -1):
            runs, p, contexts, weight = self.orders[k - 1]
            found, at = _look(runs, hashed(context[open_], symbol[open_], k))
            out[open_[found]] += p[at[found]]
            open_ = open_[~found]
            c = context[open_] & MASKS[k - 1]
            known, at = _look(contexts, hashed(c, np.zeros_like(c), k))
            out[open_[known]] += weight[at[known]]
        out[open_] -= np.log(ALPHABET)
        return out


def _look(keys, wanted):
    import numpy as np

    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), int)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def models(counts: DataFrame) -> dict[str, Model]:
    import numpy as np

    table = counts.toArrow()
    if not table.num_rows:
        return {}
    names = table["class"].combine_chunks().dictionary_encode()
    of = names.indices.to_numpy()
    columns = [table[c].to_numpy() for c in ("context", "symbol", "n")]
    return {name: Model(*(c[np.flatnonzero(of == i)] for c in columns)) for i, name in enumerate(names.dictionary.to_pylist())}
