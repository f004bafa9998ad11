"""Wavelet matrices and what is cut and written with them, against plain loops."""

import hashlib
import struct

import numpy as np
import pytest
from formline.llm import fim, tokenfiles
from formline.llm.tokens import Encoder
from formline.llm.wavelet import Plane, WaveletMatrix
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("alphabet,length", [(1, 0), (1, 5), (2, 64), (8, 1000), (700, 5000)])
def test_matrix(alphabet, length):
    codes = np.random.default_rng(length).integers(0, alphabet, length).astype(np.uint16)
    matrix = WaveletMatrix.of(codes, alphabet)
    assert (matrix.codes(np.uint16) == codes).all()
    if length:
        assert (matrix.access(np.arange(length)) == codes).all()
    for code in {0, alphabet - 1, int(codes[0]) if length else 0}:
        assert matrix.count(code) == (codes == code).sum()
        assert matrix.find(code).tolist() == np.flatnonzero(codes == code).tolist()
        places = np.arange(length + 1)
        assert matrix.rank(code, places).tolist() == [int((codes[:p] == code).sum()) for p in places]


def test_plane_selects():
    bits = np.random.default_rng(1).random(3000) < 0.2
    plane = Plane.of(bits)
    assert plane.select(np.arange(plane.ones), 1).tolist() == np.flatnonzero(bits).tolist()
    assert plane.select(np.arange(plane.zeros), 0).tolist() == np.flatnonzero(~bits).tolist()


TEXTS = [
    (None, "a null id"), (1, None), (2, ""), (3, "é"), (4, "日本語 テキスト 😀 x"), (5, "has <S> inside"), (6, "<" * 50 + "S" * 3), (7, "a\nb\nc. d! e"), (8, "xé " * 100_000),
    (9, "one"), (9, "one"), (10, "<P"), (11, "x<M y>"), (12, " lead and trail "), *[(100 + i, "words in a row " * i) for i in range(60)],
]


def brute(i, text, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(m in text for m in markers) or h[2] % 100 >= 90:
        return (i, len(text), "plain", None, None, text)
    p, s, m = markers
    if h[3] % 100 < 20:
        return (i, len(text), "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b])
    return (i, len(text), "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b])


def test_fill_in_middle(spark, make_docs):
    out = fim.fill_in_middle(make_docs(TEXTS))
    rows = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r)[:6] for r in rows), key=key) == sorted((brute(i, t) for i, t in TEXTS), key=key)
    assert sorted(((r.doc_id or -1, r.back) for r in rows)) == sorted((i or -1, t or "") for i, t in TEXTS)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit,opens", [("word", " \t\n\v\f\r"), ("line", "\n\v\f\r"), ("sentence", ".!?")])
def test_units(spark, make_docs, unit, opens):
    """Cuts lie at a text's ends or before a character that begins a unit."""
    rows = fim.fill_in_middle(make_docs(TEXTS), unit=unit, plain_percent=0, spm_percent=50, seed="x").collect()
    texts = {i: t or "" for i, t in TEXTS}
    for r in rows:
        if r.form != "plain":
            for place in (r.prefix_chars, r.prefix_chars + r.middle_chars):
                assert place in (0, r.n) or texts[r.doc_id][place] in opens
    assert any(0 < (r.prefix_chars or 0) < r.n for r in rows)


def test_markers_that_cannot_be_told_apart(spark, make_docs):
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("aba", "x", "y"), ("ab", "bc", "z"), ("abc", "b", "z")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(make_docs([]), markers=bad)


ODD = [
    "It's 'REd, don't!'s 12'3 x1y", "É́é ÀÉÎ ß × ÷ a×b «q»,r", "H̱ ẖİ", "日本 語,x 😀'll", "<|endoftext|> a <|startoftext|>b", "", None, "   ", "a b c,d", "≠≮ ≠", "'S'T'RE ''ve !!'m",
    "x\x00y\x7f", "ΑΣ ΣΑΣ.", "İstanbul K ǅ ﬁ", "1́ a1́", "<|", "a" * 5000,
]


def test_pieces_give_the_ids_of_whole_texts():
    import pyarrow as pa

    with open(PATH, encoding="utf-8") as f:
        text = f.read()
    own, whole = Encoder(text), tokenizers.Tokenizer.from_file(PATH)
    assert own.by_piece
    rng = np.random.default_rng(5)
    letters = np.array(list("aB'.,!é É×1 2\t\n<|>sStTrRevVmlLdD̸́日ß-Ａ٣"))
    made = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    ids, ends = own.encode(pa.array(ODD + made))
    starts = [0, *ends[:-1].tolist()]
    for t, a, b in zip(ODD + made, starts, ends.tolist(), strict=True):
        assert ids[a:b].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("shard_tokens,slice_bytes", [(4_000_000, 8 << 20), (300, 1000)])
def test_token_files(spark, make_docs, tmp_path, shard_tokens, slice_bytes):
    pairs = [(i, t) for i, t in TEXTS if i != 8] + [(20 + i, t) for i, t in enumerate(ODD)]
    path = f"{tmp_path}/tokens"
    tokenfiles.write_tokens(make_docs(pairs).repartition(5), path, PATH, end_id=2, shard_tokens=shard_tokens, slice_bytes=slice_bytes)
    rows = tokenfiles.read_tokens(spark, path).orderBy("start").collect()
    whole = tokenizers.Tokenizer.from_file(PATH)
    want = sorted((-1 if i is None else i, (*whole.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in pairs)
    got = [(-1 if r.doc_id is None else r.doc_id, struct.unpack(f"<{r.n_tokens}I", r.ids)) for r in rows]
    assert sorted(got) == want and [i for i, _ in got] == sorted(i for i, _ in got)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    token = got[-1][1][0]
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n, r.places) for r in tokenfiles.find_token(spark, path, token).collect())
    places = [(i, [k for k, x in enumerate(ids) if x == token]) for i, ids in want]
    assert found == sorted((i, len(p), p) for i, p in places if p)
    counts = {r.token: r.n for r in tokenfiles.token_counts(spark, path, [token, 2, 49_406, 99_999]).collect()}
    flat = [x for _, ids in want for x in ids]
    assert counts == {t: flat.count(t) for t in (token, 2, 49_406, 99_999)}


def test_no_token_files(spark, make_docs, tmp_path):
    tokenfiles.write_tokens(make_docs([]), f"{tmp_path}/none", PATH, end_id=2)
    assert tokenfiles.read_tokens(spark, f"{tmp_path}/none").collect() == []


def test_a_broken_shard_is_told(tmp_path):
    import io

    import pyarrow as pa

    data = tokenfiles.pack(pa.array([1, 2]), [2, 1], np.array([5, 70_000, 5], np.uint32))
    shard = tokenfiles.TokenFile(io.BytesIO(data))
    assert shard.all().tolist() == [5, 70_000, 5] and shard.document(0).tolist() == [5, 70_000] and shard.count(7) == 0
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(io.BytesIO(data[:-3]))
