"""Fill-in-the-middle: cut texts at drawn units and put the middle last.

Texts are cut as UTF-8 bytes. A wavelet matrix over eight classes of bytes gives
the number of units that begin before any byte as a combination of ranks: every
class but continuation bytes for code points, white space for words, and so on.
A drawn unit's first byte is found by bisection on those ranks, for all texts of a
slice together, so no text is decoded or walked through.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.wavelet import WaveletMatrix
from formline.llm.words import text_slices

CONTINUATION, BREAK, SPACE, STOP, MARK, DIGIT, LETTER, OTHER = range(8)
#: Classes whose bytes begin a unit; the beginning of a text begins one as well.
UNITS = {
    "char": (BREAK, SPACE, STOP, MARK, DIGIT, LETTER, OTHER),
    "word": (BREAK, SPACE),
    "line": (BREAK,),
    "sentence": (STOP,),
}
MARKERS = ("<P>", "<S>", "<M>")


@lru_cache(1)
def byte_classes():
    """The class of every byte value."""
    import numpy as np

    out = np.full(256, MARK, np.uint8)
    out[0x80:0xC0], out[0xC0:] = CONTINUATION, OTHER
    for kind, some in ((BREAK, b"\n\v\f\r"), (SPACE, b"\t "), (STOP, b".!?")):
        out[list(some)] = kind
    out[ord("0") : ord("9") + 1] = DIGIT
    out[ord("a") : ord("z") + 1] = out[ord("A") : ord("Z") + 1] = LETTER
    return out


class Units:
    """Where units begin in some bytes."""

    def __init__(self, data, unit: str):
        self.matrix = WaveletMatrix.of(byte_classes()[data], 8)
        self.unit = UNITS[unit]

    def before(self, places, kinds=None):
        """Units that begin before each place: a sum of ranks, or what the other classes leave."""
        kinds = self.unit if kinds is None else kinds
        if len(kinds) <= 4:
            return sum(self.matrix.rank(k, places) for k in kinds)
        return places - sum(self.matrix.rank(k, places) for k in range(8) if k not in kinds)

    def chars(self, places):
        return self.before(places, UNITS["char"])

    def number(self, starts, ends):
        """Units of each text: one at its beginning, and those that begin inside."""
        import numpy as np

        inner = np.minimum(starts + 1, ends)
        return np.where(ends > starts, 1 + self.before(ends) - self.before(inner), 0)

    def place(self, starts, ends, wanted):
        """The byte at which unit number ``wanted`` of each text begins; its end for the number after the last."""
        import numpy as np

        inner = np.minimum(starts + 1, ends)
        goal = self.before(inner) + wanted
        low, high = inner.copy(), ends.copy()  # least byte with as many units begun after it, by halves
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.before(np.minimum(middle + 1, ends)) >= goal
            low, high = np.where(enough | (low >= high), low, middle + 1), np.where(enough, middle, high)
        return np.where(wanted <= 0, starts, low)


def _checked(markers) -> tuple[str, str, str]:
    """Markers that can be found again: none empty, none inside another, none that overlaps itself or another."""
    for a in markers:
        for b in markers:
            inside = a != b and a in b
            if not a or inside or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"markers {a!r} and {b!r} can't be told apart")
    if len(set(markers)) != 3:
        raise ValueError("three different markers are needed")
    return tuple(markers)


def draws(id_col: Column, seed: str = "1") -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", markers=MARKERS, plain_percent: int = 10,
    spm_percent: int = 20, seed: str = "1",
) -> DataFrame:
    """One row per document: ``id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts code points. A text of u units is cut before two units drawn
    from 0 to u (its end) by the id alone, so reruns agree. ``form`` is plain (the
    text as it is) for texts that are null, empty or hold a marker and for
    ``plain_percent`` of the others; of the rest ``spm_percent`` take the order
    suffix, prefix, middle and all others prefix, suffix, middle. The lengths are
    in code points, null for plain texts.

    Rows that repeat are cut alike; a null id draws as an empty one. Nothing is
    shuffled, and a task holds about 2 MB of text, or one longer text, at a time.
    """
    p, s, m = (x.encode() for x in _checked(markers))
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains(text, F.lit(marker))
    plain = (text == "") | marked | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_slices(batches):
            texts = batch["text"].cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            first = int(offsets[0])
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : int(offsets[-1])]
            starts, ends = offsets[:-1] - first, offsets[1:] - first
            units = Units(data, unit)
            number = units.number(starts, ends) + 1
            a, b = (batch[c].to_numpy() % number for c in ("h1", "h2"))
            one, two = (units.place(starts, ends, f(a, b)) for f in (np.minimum, np.maximum))
            at = [units.chars(x) for x in (starts, one, two, ends)]
            forms, raw, out = batch["form"].to_pylist(), data.tobytes(), []
            for f, i, j, k, e in zip(forms, starts.tolist(), one.tolist(), two.tolist(), ends.tolist(), strict=True):
                if f == "plain":
                    out.append(raw[i:e])
                elif f == "psm":
                    out.append(b"".join((p, raw[i:j], s, raw[k:e], m, raw[j:k])))
                else:
                    out.append(b"".join((s, raw[k:e], p, raw[i:j], m, raw[j:k])))
            bare = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], pa.array(at[3] - at[0]), batch["form"], pa.array(at[1] - at[0], mask=bare), pa.array(at[2] - at[1], mask=bare),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    done = rows.mapInArrow(cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return done.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, markers=MARKERS) -> Column:
    """The text that an output of ``fill_in_middle`` was made of. Native; each marker is the first of its kind."""
    p, s, m = _checked(markers)

    def between(left: str, right: str | None) -> Column:
        """What stands after the first ``left``, up to the first ``right``."""
        start = F.locate(left, output) + F.lit(len(left))
        upto = F.locate(right, output) if right else F.char_length(output) + 1
        return F.substring(output, start, upto - start)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
