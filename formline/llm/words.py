"""Words, normal forms and keys of texts, as columns and as Arrow arrays."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: what stands between space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of one byte per character take the fast built-in."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def word_count(col: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def in_fold(id_col: str, folds: int = 5) -> Column:
    """True for the rows held out: crc32 of the id as text leaves no remainder. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def text_key(col: Column) -> Column:
    """64 bits that, with the id, name a row in joins. Rows that agree in id and text get the same results."""
    return F.xxhash64(col)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are dropped."""
    right = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for c in keys:
        match = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = match if on is None else on & match
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{c}" for c in keys])


# Inside Python tasks: the words of a batch of texts as arrays.


def text_slices(batches, column: str = "text", size: int = 2 << 20):
    """Record batches cut to about ``size`` bytes of text each, one row at least, so that a task holds little at a time."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)))
            yield batch.slice(at, upto - at)
            at = upto


def split_words(texts):
    """``(words, offsets)``: all words of an Arrow array of texts, and where each text's words begin and end.

    The built-in split takes exactly the six characters of SPACES as white space.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)
    real = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), before[offsets].astype(np.int64)


def hash_words(words, keys=("formline-words-a", "formline-words-b")):
    """One array of 64-bit hashes per key (16 characters each); every distinct word is hashed once."""
    import numpy as np
    from pandas.util import hash_array

    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    distinct = np.asarray(coded.dictionary.to_pylist(), dtype=object)
    return [hash_array(distinct, hash_key=k, categorize=False)[codes] if len(distinct) else np.zeros(0, np.uint64) for k in keys]


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def hash_runs(hashes, length: int):
    """The hash of ``length`` consecutive items from each position on, built by doubling; shorter than the input by length - 1."""
    import numpy as np

    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    n, power, have, done, out = len(hashes) - length + 1, hashes, 1, 0, None
    while True:
        if length & have:
            piece = power[done : done + n]
            out = piece if out is None else _mix(out * np.uint64(0xD6E8FEB86659FD93) + piece)
            done += have
        if done == length:
            return _mix(out)
        power = _mix(power[:-have] * np.uint64(0xA24BAED4963EE407) + power[have:]) if len(power) > have else power[:0]
        have *= 2
