"""Remove long passages that occur more than once, found by difference-cover anchors.

Two occurrences of a passage start at positions i and j. A difference cover D of
period v has, for any i and j, a shift s < v with (i + s) mod v and (j + s) mod v
both in D. So hashes of runs of ``window - v + 1`` words are taken at positions in
D only (5 of 21 for windows of 35), and any two equal windows share such an
aligned anchor. Anchors seen once end there. Around the others the match is
extended: the whole windows that hold them are hashed to 128 bits and counted.

No pairs are made. Texts are dealt once into chunks of a few megabytes. A chunk
sends each distinct hash once, packed by hash range; the task of a range answers
each chunk with those of its hashes that occur elsewhere as well. A passage in a
third of all documents is thus one hash from each chunk, and no task ever holds
all its occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.words import hash_runs, hash_words, split_words

#: Perfect difference sets: period and positions.
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
LEAST_ANCHOR = 12
SENT = "bucket long, chunk long, hashes binary, often binary"
ANSWER = "chunk long, hashes binary"


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The widest period that leaves anchors of LEAST_ANCHOR words (1: every position)."""
    period = max((v for v in COVERS if window - v + 1 >= LEAST_ANCHOR), default=1)
    return period, COVERS[period]


class _Chunk:
    """The words of a chunk's documents in a row, with the starts of its windows."""

    def __init__(self, texts, window: int):
        import numpy as np

        self.words, self.offsets = split_words(texts)
        self.window = window
        self.counts = np.diff(self.offsets)
        self.start = np.repeat(self.offsets[:-1], self.counts)
        self.end = np.repeat(self.offsets[1:], self.counts)

    def __len__(self):
        return len(self.words)

    def window_hashes(self, hashes):
        """128 bits for each position as rows of two, and whether a window of one document starts there."""
        import numpy as np

        full = [hash_runs(h, self.window) for h in hashes]
        n = len(full[0])
        return np.stack(full, axis=1), np.arange(n) + self.window <= self.end[:n]

    def anchors(self, hashes, period: int, cover):
        """Positions in the cover, counted in their document, and the hashes of their runs."""
        import numpy as np

        length = self.window - period + 1
        runs = hash_runs(hashes, length)
        at = np.arange(len(runs))
        wanted = np.zeros(period, bool)
        wanted[list(cover)] = True
        # An anchor outside all windows of its document is of no use.
        inside = (at + length <= self.end[: len(runs)]) & (self.counts.repeat(self.counts)[: len(runs)] >= self.window)
        at = at[inside & wanted[(at - self.start[: len(runs)]) % period]]
        return at, runs[at]

    def near(self, marked, period: int):
        """Whether the window at each position holds a marked anchor among its first ``period`` words."""
        import numpy as np

        steps = np.zeros(len(self) + 1, np.int64)
        np.add.at(steps, np.maximum(marked - period + 1, self.start[marked]), 1)
        np.add.at(steps, marked + 1, -1)
        return np.cumsum(steps[:-1]) > 0

    def covered(self, starts):
        import numpy as np

        steps = np.zeros(len(self) + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + self.window, -1)
        return np.cumsum(steps[:-1]) > 0


def _as_table(columns: dict, schema: list):
    import pyarrow as pa

    return pa.table({name: pa.array(columns[name], kind) for name, kind in schema})


def _send(chunk: int, hashes, buckets: int):
    """The distinct rows of ``hashes``, cut by ranges of the first column, with a flag for those seen more than once here."""
    import numpy as np
    import pyarrow as pa

    hashes = hashes.reshape(-1, 1) if hashes.ndim == 1 else hashes
    hashes = hashes[np.lexsort(hashes.T[::-1])]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    often = (np.diff(np.append(first, len(hashes))) > 1).astype(np.uint8)
    hashes = np.ascontiguousarray(hashes[first])
    bucket = ((hashes[:, 0] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    found, at = np.unique(bucket, return_index=True)
    ends = np.append(at, len(hashes))
    spans = list(zip(ends[:-1], ends[1:], strict=True))
    return _as_table(
        {
            "bucket": found.astype(np.int64), "chunk": [chunk] * len(found),
            "hashes": [hashes[a:b].tobytes() for a, b in spans], "often": [often[a:b].tobytes() for a, b in spans],
        },
        [("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("often", pa.binary())],
    )


def _answer(width: int):
    """Of all chunks' hashes of one range, tells each chunk those that occur twice or more."""

    def answer(table):
        import numpy as np
        import pyarrow as pa

        parts = [np.frombuffer(x, np.uint64).reshape(-1, width) for x in table["hashes"].to_pylist()]
        own = np.repeat(table["chunk"].to_numpy(), [len(p) for p in parts])
        often = np.frombuffer(b"".join(table["often"].to_pylist()), np.uint8)
        every = np.concatenate(parts)
        order = np.lexsort(every.T[::-1])
        every, own, often = every[order], own[order], often[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        again = (np.bincount(group) > 1) | (np.bincount(group, weights=often) > 0)
        keep = again[group]
        every, own = every[keep], own[keep]
        order = np.argsort(own, kind="stable")
        every, own = every[order], own[order]
        chunks, at = np.unique(own, return_index=True)
        ends = np.append(at, len(own))
        return _as_table(
            {"chunk": chunks, "hashes": [every[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]},
            [("chunk", pa.int64()), ("hashes", pa.binary())],
        )

    return answer


def _received(table, width: int):
    """A chunk's answers as sorted rows."""
    import numpy as np

    rows = np.frombuffer(b"".join(table["hashes"].to_pylist()), np.uint64).reshape(-1, width)
    return rows[np.lexsort(rows.T[::-1])]


def _member(rows, sorted_rows):
    """Which rows are among ``sorted_rows``. Rows of equal first column stand together; there are hardly ever two."""
    import numpy as np

    if not len(sorted_rows) or not len(rows):
        return np.zeros(len(rows), bool)
    at = np.searchsorted(sorted_rows[:, 0], rows[:, 0])
    found = np.zeros(len(rows), bool)
    open_ = np.flatnonzero(at < len(sorted_rows))
    while len(open_):
        open_ = open_[sorted_rows[at[open_], 0] == rows[open_, 0]]
        found[open_] |= (sorted_rows[at[open_]] == rows[open_]).all(axis=1)
        at[open_] += 1
        open_ = open_[(at[open_] < len(sorted_rows)) & ~found[open_]]
    return found


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, chunk_bytes: int = 2 << 20,
    buckets_per_chunk: float = 0.25,
) -> DataFrame:
    """One row per document with the words that repeated windows cover taken out.

    A window is ``window`` consecutive words of a document. It is repeated when
    its word sequence also starts at another place, in this document or another;
    windows are judged on the input. Returns ``id, n_words, n_removed, kept_text``
    (the kept words joined by spaces) and ``spans`` (start and end, in words, of
    what was removed).

    Null and empty texts have no words and an empty kept_text. Repeated rows are
    copies of each other like any others; each gets its row. Documents of fewer
    words than a window keep them all. No rows give no rows.

    ``chunk_bytes`` bounds what a task holds, one document at least. Chunks are
    dealt by id, text and place in the input; the dealt texts are one shuffle that
    all passes read.
    """
    period, cover = cover_for(window)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0  # one number
    chunks = max(1, -(-total // chunk_bytes))
    buckets = max(1, int(chunks * buckets_per_chunk))
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.monotonically_increasing_id()), F.lit(chunks)).alias("__chunk"),
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
    )

    def send_anchors(table):
        chunk = _Chunk(table["__text"], window)
        (hashes,) = hash_words(chunk.words, ("formline-anchors",))
        return _send(table["__chunk"][0].as_py(), chunk.anchors(hashes, period, cover)[1], buckets)

    def send_windows(table, answers):
        known = _received(answers, 1)
        chunk = _Chunk(table["__text"], window)
        number = table["__chunk"][0].as_py() if table.num_rows else 0
        if not len(known) or len(chunk) < window:
            return _send(number, _nothing(2), buckets)
        (hashes,) = hash_words(chunk.words, ("formline-anchors",))
        at, runs = chunk.anchors(hashes, period, cover)
        marked = at[_member(runs.reshape(-1, 1), known)]
        full, valid = chunk.window_hashes(hash_words(chunk.words))
        return _send(number, full[chunk.near(marked, period)[: len(full)] & valid], buckets)

    def remove(table, answers):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        chunk = _Chunk(table["__text"], window)
        known = _received(answers, 2)
        gone = np.zeros(len(chunk), bool)
        if len(known) and len(chunk) >= window:
            full, valid = chunk.window_hashes(hash_words(chunk.words))
            starts = np.flatnonzero(valid)
            gone = chunk.covered(starts[_member(full[starts], known)])
        removed = np.concatenate([[0], np.cumsum(gone)])
        ends = chunk.offsets - removed[chunk.offsets]
        kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunk.words.filter(pa.array(~gone)).cast(pa.string())), " ")
        edge = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (chunk.start[1:] == chunk.start[:-1])])) if len(chunk) else np.zeros(0, int)
        last = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (chunk.start[1:] == chunk.start[:-1]), [False]])) if len(chunk) else np.zeros(0, int)
        each = np.searchsorted(edge, chunk.offsets)
        base = chunk.start[edge] if len(chunk) else edge
        spans = pa.ListArray.from_arrays(
            pa.array(each, pa.int32()),
            pa.StructArray.from_arrays([pa.array(edge - base, pa.int64()), pa.array(last + 1 - base, pa.int64())], ["start", "end"]),
        )
        return pa.table(
            {
                id_col: table["__id"], "n_words": pa.array(chunk.counts, pa.int64()),
                "n_removed": pa.array(np.diff(removed[chunk.offsets]), pa.int64()), "kept_text": kept.cast(pa.string()), "spans": spans,
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    own = dealt.groupBy("__chunk")
    anchors = own.applyInArrow(send_anchors, SENT).groupBy("bucket").applyInArrow(_answer(1), ANSWER)
    windows = own.cogroup(anchors.groupBy("chunk")).applyInArrow(send_windows, SENT).groupBy("bucket").applyInArrow(_answer(2), ANSWER)
    schema = f"`{id_col}` {kind}, n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>"
    return own.cogroup(windows.groupBy("chunk")).applyInArrow(remove, schema)


def _nothing(width: int):
    import numpy as np

    return np.zeros((0, width), np.uint64)
