"""Wavelet matrices over small alphabets, as numpy arrays inside a task.

A sequence of codes is stored as one bit-plane per binary digit, highest first;
after each plane the codes are dealt stably, zeros before ones. Ranks inside the
planes then answer how often a code stands before a position, which code stands
at it, and where a code's k-th occurrence is, without the sequence itself.
"""

from __future__ import annotations

WORD = 64


def digits(alphabet: int) -> int:
    """Planes that an alphabet needs, one at least."""
    return max(1, int(alphabet - 1).bit_length())


class Plane:
    """Bits packed into 64-bit words, with the number of ones before each word."""

    def __init__(self, words, length: int):
        import numpy as np

        self.words, self.length = words, length
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.ones = int(self.before[-1])
        self.zeros = length - self.ones

    @classmethod
    def of(cls, bits) -> Plane:
        import numpy as np

        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // WORD + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        return cls(words, len(bits))

    def bits(self):
        import numpy as np

        return np.unpackbits(self.words.view(np.uint8), count=self.length, bitorder="little").view(bool)

    def at(self, places):
        import numpy as np

        return (self.words[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, places):
        """Ones before each place."""
        import numpy as np

        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[places >> 6] + np.bitwise_count(self.words[places >> 6] & below)

    def select(self, ranks, bit: int):
        """Where the ones (or zeros) with these ranks, counted from 0, stand."""
        import numpy as np

        ranks = np.asarray(ranks, np.int64)
        before = self.before if bit else np.arange(len(self.before), dtype=np.int64) * WORD - self.before
        word = np.searchsorted(before, ranks, side="right") - 1
        inside, rest = np.zeros(len(ranks), np.int64), ranks - before[word]
        held = self.words[word] if bit else ~self.words[word]
        for step in (32, 16, 8, 4, 2, 1):  # halve the word: is the bit in its upper part?
            low = np.bitwise_count(held & np.uint64((1 << step) - 1))
            upper = rest >= low
            rest = np.where(upper, rest - low, rest)
            held = np.where(upper, held >> np.uint64(step), held)
            inside += np.where(upper, step, 0)
        return word * WORD + inside


class WaveletMatrix:
    def __init__(self, planes: list[Plane], length: int):
        self.planes, self.length = planes, length

    @classmethod
    def of(cls, codes, alphabet: int) -> WaveletMatrix:
        import numpy as np

        planes, digit = [], digits(alphabet)
        for shift in reversed(range(digit)):
            bits = (codes >> codes.dtype.type(shift) & codes.dtype.type(1)).astype(bool)
            planes.append(Plane.of(bits))
            codes = codes[np.concatenate([np.flatnonzero(~bits), np.flatnonzero(bits)])]
        return cls(planes, len(codes))

    def codes(self, kind):
        """The whole sequence again, by undoing the deals from the last plane up."""
        import numpy as np

        out = np.zeros(self.length, kind)
        for shift, plane in enumerate(reversed(self.planes)):
            bits, dealt = plane.bits(), out
            out = np.empty(self.length, kind)
            out[np.flatnonzero(~bits)] = dealt[: plane.zeros]
            out[np.flatnonzero(bits)] = dealt[plane.zeros :] | np.array(1 << shift, kind)
        return out

    def access(self, places):
        """The codes at some places."""
        import numpy as np

        places = np.asarray(places, np.int64)
        out = np.zeros(len(places), np.int64)
        for plane in self.planes:
            bit, ones = plane.at(places), plane.rank(places)
            out = out << 1 | bit
            places = np.where(bit, plane.zeros + ones, places - ones)
        return out

    def rank(self, code: int, places):
        """How often the code stands before each place."""
        import numpy as np

        low, high = np.zeros(1, np.int64), np.asarray(places, np.int64)
        for shift, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            if code >> shift & 1:
                low, high = plane.zeros + plane.rank(low), plane.zeros + plane.rank(high)
            else:
                low, high = low - plane.rank(low), high - plane.rank(high)
        return high - low

    def count(self, code: int) -> int:
        import numpy as np

        return int(self.rank(code, np.array([self.length]))[0]) if 0 <= code < 1 << len(self.planes) else 0

    def find(self, code: int):
        """All places of a code, rising: its block below the last plane is followed up again by selects."""
        import numpy as np

        low, many = np.zeros(1, np.int64), self.count(code)
        path = []
        for shift, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            bit = code >> shift & 1
            path.append((plane, bit))
            low = plane.zeros + plane.rank(low) if bit else low - plane.rank(low)
        places = low[0] + np.arange(many, dtype=np.int64)
        for plane, bit in reversed(path):
            places = plane.select(places - plane.zeros if bit else places, bit)
        return places
