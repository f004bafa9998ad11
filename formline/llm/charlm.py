"""Interpolated Kneser-Ney models over characters, of a size that no corpus can exceed.

Texts are read as words over 32 symbols: 0 between words, 1-26 for a-z in either
case, 27-31 for all other letters by a hash of the code point. Context reaches
back three symbols and never over the beginning of a word, so texts in one array
don't touch. A run of four symbols is a cell from 0 to 2^20 - 1: its exact hash.
Counts of cells are summed over all texts by Spark; what reaches the driver is at
most one number for each cell and class.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.words import text_slices

SYMBOLS, ORDER = 32, 4
CELLS = SYMBOLS**ORDER
SLICE_CHARS = 1 << 20


@lru_cache(1)
def symbol_table():
    """The symbol of every code point."""
    import numpy as np

    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[point] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 % 2**32 >> 7) % 5
    return out


def cells(texts: list[str]):
    """``(cells, ends)``: a cell for each symbol of the texts, one after another, and where each text's begin and end."""
    import numpy as np

    joined = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = symbol_table()[points]
    keep = x != 0
    keep[1:] |= x[:-1] != 0
    before = np.concatenate([[0], np.cumsum(keep)])
    starts = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in texts])]) if texts else np.array([1])
    x = x[keep].astype(np.int32)
    x = np.concatenate([[0, 0, 0], x]) if keep[0] else np.concatenate([[0, 0, 0, 0], x])
    shift = 0 if keep[0] else 1
    one = x[2:-1]
    two = np.where(one == 0, 0, x[1:-2])
    three = np.where(two == 0, 0, x[:-3])
    return x[3:] | one << 5 | two << 10 | three << 15, before[starts] + shift


def slices(texts: list, most: int = SLICE_CHARS):
    """Ranges of the list with about that many characters each, one text at least."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size > most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def count_cells(texts: DataFrame, class_col: str, text_col: str, at_once: int = 8) -> DataFrame:
    """``class, cell, n`` over all rows and whole texts. A task holds the counts of few classes at a time."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}

        def sent():
            for name, n in held.items():
                found = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(n[found], pa.int64())], ["class", "cell", "n"]
                )
            held.clear()

        for batch in text_slices(batches):
            names, texts_ = batch["class"].to_pylist(), batch["text"].to_pylist()
            for a, b in slices([t or "" for t in texts_]):
                by_class: dict[str, list[str]] = {}
                for name, text in zip(names[a:b], texts_[a:b], strict=True):
                    if name is not None and text:
                        by_class.setdefault(name, []).append(text)
                for name, some in by_class.items():
                    if name not in held:
                        if len(held) >= at_once:
                            yield from sent()
                        held[name] = np.zeros(CELLS, np.int64)
                    found, ends = cells(some)
                    held[name] += np.bincount(found[ends[0] :], minlength=CELLS)
        yield from sent()

    rows = texts.select(F.col(class_col).cast("string").alias("class"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "class string, cell int, n long").groupBy("class", "cell").agg(F.sum("n").alias("n"))


def collected(counts: DataFrame) -> dict:
    """One array of CELLS counts per class, on the driver."""
    import numpy as np

    out: dict[str, np.ndarray] = {}
    table = counts.toArrow()
    names = table["class"].combine_chunks().dictionary_encode() if table.num_rows else None
    if names is None:
        return out
    of, cell, n = names.indices.to_numpy(), table["cell"].to_numpy(), table["n"].to_numpy()
    for i, name in enumerate(names.dictionary.to_pylist()):
        out[name] = np.bincount(cell[of == i], weights=n[of == i], minlength=CELLS)
    return out


def _levels(counts):
    """Counts of the highest order, below it continuation counts: how many different symbols stand before a run."""
    levels = [counts]
    for k in range(ORDER, 1, -1):
        levels.append((levels[-1].reshape(SYMBOLS, -1) > 0).sum(axis=0).astype(float))
    return levels[::-1]


def kneser_ney(counts, shared=None, shared_orders: int = 0):
    """The probability of each cell's last symbol after its first three.

    Discounts come from the numbers of runs seen once and twice. Orders up to
    ``shared_orders`` are estimated from the counts ``shared``, so that classes
    with few texts back off to what all texts say.
    """
    import numpy as np

    own, base = _levels(counts), _levels(shared) if shared is not None else None
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(1, ORDER + 1):
        n = (base if k <= shared_orders else own)[k - 1].reshape(-1, SYMBOLS)
        once, twice = (n == 1).sum(), (n == 2).sum()
        discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
        total = n.sum(axis=1, keepdims=True)
        some = np.maximum(total, 1)
        lower = p.reshape(1, SYMBOLS) if k == 1 else np.tile(p.reshape(-1, SYMBOLS), (1 if k == 2 else SYMBOLS, 1))
        if k == 2:
            lower = np.tile(p.reshape(1, SYMBOLS), (SYMBOLS, 1))
        weight = np.where(total > 0, discount * (n > 0).sum(axis=1, keepdims=True) / some, 1.0)
        p = (np.maximum(n - discount, 0) / some + weight * lower).ravel()
    return p
