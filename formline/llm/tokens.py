"""Token ids of texts, by a tokenizer file and the tokenizers library."""

from __future__ import annotations

import json
from functools import lru_cache

#: The word tokenizer's way of cutting text, for which ``Encoder`` may encode each distinct piece once.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, DIGIT, SIGN, APOSTROPHE, OTHER = range(6)
CACHED = 1_000_000
JOINED = 256


class Encoder:
    """Ids of texts. A tokenizer that cuts text by WORD_PATTERN encodes each distinct piece once.

    Such a tokenizer never looks across white space, nor from a letter to an ASCII
    digit or sign, nor from a sign other than an apostrophe to a letter or digit:
    no match of the pattern spans these places, and normal forms compose nothing
    there. So texts are cut there, pieces are encoded by the library, and their
    ids put together again. Pieces of letters take one match each; many are encoded
    in one call and told apart by the ids that end a word. Texts that hold a
    special token, and texts under any other tokenizer, are encoded as they are.
    """

    def __init__(self, text: str):
        """``text`` is the content of the tokenizer's JSON file."""
        import numpy as np
        from tokenizers import Tokenizer

        spec = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.by_piece = cuts == WORD_PATTERN and steps == ["NFC", "Replace", "Lowercase"] and spec.get("post_processor") is None
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32
        suffix = spec["model"].get("end_of_word_suffix") or None
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.known, self.flat, self.used = {}, np.zeros(1 << 16, self.kind), 0
        self.starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def encode(self, texts):
        """``(ids, ends)`` of an Arrow array of texts: all ids in a row, and where each text's end. A null text has none."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        raw = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        whole = np.ones(len(raw), bool)
        if self.by_piece:
            whole[:] = False
            for token in self.special:
                whole |= pc.match_substring(raw, token.decode()).to_numpy(zero_copy_only=False)
        if whole.all():
            got = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(raw.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.kind), *got]), np.cumsum([len(g) for g in got], dtype=np.int64)
        ids, ends = self._by_piece(data, offsets)
        if whole.any():
            starts = np.concatenate([[0], ends[:-1]])
            parts = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
            for i in np.flatnonzero(whole):
                parts[i] = np.array(self.tokenizer.encode(raw[int(i)].as_py(), add_special_tokens=False).ids, self.kind)
            ids, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts], dtype=np.int64)
        return ids, ends

    def _by_piece(self, data, offsets):
        import numpy as np

        pieces, simple, firsts = split_pieces(data, offsets)
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        kinds = np.zeros(len(distinct), bool)
        kinds[codes] = simple
        at = self._places(distinct, kinds)
        lengths = self.lengths[at][codes]
        after = np.cumsum(lengths)
        places = np.arange(int(after[-1]) if len(after) else 0, dtype=np.int64)
        places += np.repeat(self.starts[at][codes] - after + lengths, lengths)
        return self.flat[places], np.concatenate([[0], after])[firsts[1:]]

    def _places(self, pieces: list[bytes], simple):
        """The number of each piece among those known; new ones are encoded."""
        import numpy as np

        if len(self.known) > CACHED:
            self.forget()
        at = list(map(self.known.get, pieces))
        new = [i for i, place in enumerate(at) if place is None]
        letters = [pieces[i] for i in new if simple[i]]
        single = [pieces[i] for i in new if not simple[i]]
        groups = [letters[i : i + JOINED] for i in range(0, len(letters), JOINED)]
        for group, found in zip(groups, self._raw([b" ".join(g) for g in groups]), strict=True):
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) == len(group) and ends[-1] == len(found):
                self._learn(group, found, np.diff(ends, prepend=0))
            else:
                single += group
        found = self._raw(single)
        self._learn(single, np.concatenate([np.zeros(0, self.kind), *found]), np.array([len(f) for f in found], np.int64))
        for i in new:
            at[i] = self.known[pieces[i]]
        return np.array(at, np.int64)

    def _raw(self, pieces: list[bytes]):
        import numpy as np

        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False) if pieces else []
        return [np.array(e.ids, self.kind) for e in encoded]

    def _learn(self, pieces, ids, lengths) -> None:
        import numpy as np

        first = len(self.known)
        for i, p in enumerate(pieces, first):
            self.known[p] = i
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(pieces) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[first : first + len(pieces)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(pieces)] = lengths
        self.used += len(ids)


@lru_cache(1)
def encoder(text: str) -> Encoder:
    """The encoder of a worker process, with the pieces it has met; the next task goes on with it."""
    return Encoder(text)


@lru_cache(1)
def _tables():
    """The class of each byte value, and the pairs of neighbouring classes between which text is cut."""
    import numpy as np

    kinds = np.full(256, OTHER, np.uint8)
    kinds[0x21:0x7F] = SIGN
    kinds[list(b" \t\n\v\f\r")] = SPACE
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("a") : ord("z") + 1] = kinds[ord("A") : ord("Z") + 1] = LETTER
    kinds[ord("'")] = APOSTROPHE
    cut = np.zeros((6, 6), bool)
    cut[SPACE, :] = cut[:, SPACE] = True
    cut[LETTER, [DIGIT, SIGN, APOSTROPHE]] = True
    cut[DIGIT, [LETTER, DIGIT, SIGN, APOSTROPHE]] = True
    cut[SIGN, [LETTER, DIGIT]] = True
    cut[APOSTROPHE, DIGIT] = True
    return kinds, cut.ravel()


def split_pieces(data, offsets):
    """``(pieces, simple, firsts)`` of UTF-8 bytes: the pieces in a row, whether each is of letters only, and each text's first piece.

    Letters are ASCII and Latin-1 ones (bytes C3 80 to C3 BF but for the signs C3
    97 and C3 B7), in lower case where a piece has no other bytes than those.
    """
    import numpy as np
    import pyarrow as pa

    kinds, cut = _tables()
    n = len(data)
    if not n:
        return pa.array([], pa.binary()), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    kind = kinds[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if n > 1 else np.zeros(0, np.int64)
    second = data[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7)]
    kind[lead], kind[lead + 1] = LETTER, LETTER
    start = np.empty(n, bool)
    start[0] = True
    np.take(cut, kind[:-1] * np.uint8(6) + kind[1:], out=start[1:])
    start[offsets[:-1][offsets[:-1] < n]] = True
    real = kind != SPACE
    start &= real
    begins = np.flatnonzero(start)
    if not len(begins):
        return pa.array([], pa.binary()), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    firsts = np.searchsorted(begins, offsets)
    piece = np.cumsum(start, dtype=np.int32) - 1
    simple = np.ones(len(begins), bool)
    simple[piece[np.flatnonzero(kind > LETTER)]] = False
    lower = data.copy()
    upper = (data >= 0x41) & (data <= 0x5A)
    upper[lead + 1] |= data[lead + 1] <= 0x9E
    flip = np.flatnonzero(upper)
    lower[flip[simple[piece[flip]]]] += 0x20
    before = np.cumsum(real, dtype=np.int32)
    ends = np.append(before[begins] - 1, before[-1]).astype(np.int32)
    held = np.flatnonzero(real)
    buffer = pa.py_buffer(lower[held].tobytes())
    pieces = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends.tobytes()), buffer])
    return pieces, simple, firsts
