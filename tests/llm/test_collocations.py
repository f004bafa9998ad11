"""Collocations against loops over lists."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from formline.llm import collocations


def brute(pairs, longest=3, least=2, share=50, top=2000):
    out = []
    by_lang = defaultdict(list)
    for lang, text in pairs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        by_lang[lang or "und"] += [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]
    for lang, pieces in by_lang.items():
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        n = sum(len(w) for w in pieces)
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in some.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in some.items()):
                continue
            score, k = min((Fraction(1_000_000 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def made(seed, size=400):
    rng = np.random.default_rng(seed)
    words = np.array(["a", "B", "b", "é", "long-word", "x.y", "z", "q!", "\t", "r\ns", "日本", ","])
    odds = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 30), p=odds / odds.sum())) for _ in range(size)]
    langs = rng.choice(np.array(["en", "fr", None], dtype=object), size).tolist()
    return [*zip(langs, texts, strict=True), ("en", None), ("en", ""), (None, "a b c " * 3000), ("de", "only once"), ("en", " \t.,"), ("en", "wörd" * 4000)]


@pytest.mark.parametrize("settings", [{}, {"budget": 2000, "slice_bytes": 20_000}, {"budget": 500}, {"longest": 4, "budget": 3000, "slice_bytes": 20_000}, {"top": 3}, {"longest": 2, "share": 0}])
def test_against_loops(spark, settings):
    pairs = made(3)
    rows = [(lang, text, 7, "x", 1) for lang, text in pairs]
    docs = spark.createDataFrame(rows, "lang string, text string, rank long, phrase string, n long")
    got = collocations.collocations(docs, least=2, **settings)
    want = brute(pairs, **{k: v for k, v in settings.items() if k in ("longest", "share", "top")})
    assert sorted(tuple(r) for r in got.collect()) == want


def test_without_rows(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_score_beyond_64_bits(spark):
    """Counts whose squares pass 64 bits: the arithmetic is that of whole numbers."""
    from pyspark.sql import functions as F

    a, left, r = 3_000_000_007, 3_000_000_011, 3_000_000_019
    wide = {c: F.lit(v).cast("decimal(19,0)") for c, v in (("a", a), ("l", left), ("r", r))}
    row = spark.range(1).select(
        (wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)").alias("up"), (wide["l"] * wide["r"]).cast("decimal(38,0)").alias("down")
    ).select(F.expr("up div down").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * r)


def test_groups_stay_within_the_budget():
    counts = np.zeros(collocations.CLASSES, np.int64)
    counts[:6] = [5, 5, 30, 4, 9, 1]
    groups, parts = collocations.group_classes(counts, 10)
    assert groups[:6].tolist() == [0, 0, 1, 4, 5, 5] and parts[:6].tolist() == [1, 1, 3, 1, 1, 1]
