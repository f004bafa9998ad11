"""What learnt operators must tell apart beyond words and a fixed alphabet."""

import random

import numpy as np
from pyspark.sql import functions as F

from formline.llm import chargrams, charlm, langid, toxicity


def test_phrases_of_ordinary_words(spark):
    """Two words that stand in all texts are toxic only side by side."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        w = [f"{a}{b}" for a, b in zip(rng.choices(["ba", "ko", "mi", "ru"], k=60), rng.choices(["len", "tas", "vor", "nip"], k=60), strict=True)]
        for k in (10, 30, 50):
            w[k : k + 1] = ["rulen", "grey", "pond"] if i % 4 == 0 else ["grey", "rulen", "pond"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    table, truth = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(table, truth, F.col("doc_id") < 400).collect()}
    pairs = [(got[i], got[k]) for i in range(400, 600) for k in range(400, 600) if i % 4 == 0 and k % 4]
    assert np.mean([(x > y) + 0.5 * (x == y) for x, y in pairs]) > 0.99


def test_languages_of_one_script(spark):
    """Texts that differ only in letters which the toxicity models' 32 symbols fold together."""
    rng, alphabet = random.Random(6), [chr(c) for c in range(0x430, 0x450)]
    fold = charlm.symbol_table()
    same = max(([c for c in alphabet if fold[ord(c)] == k] for k in range(27, 32)), key=len)
    shared = [c for c in alphabet if c not in same]
    docs = [(i, " ".join("".join(rng.choices(shared + (same[:2] if i % 2 else same[2:4]) * 3, k=5)) for _ in range(12)), "xy"[i % 2]) for i in range(600)]
    got = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string"), F.col("doc_id") < 400).collect()
    right = [r.lang_pred == "xy"[r.doc_id % 2] for r in got if r.doc_id >= 400]
    assert len(right) == 200 and np.mean(right) == 1


def test_models_are_distributions_and_grow():
    text = "the cat sat on the mat, тот кот"
    context, symbol, ends = chargrams.grams([text, "", "a"])
    assert ends.tolist()[-1] == len(symbol) and ends[1] == ends[2]
    c, s, at = chargrams.distinct(context, symbol)
    model = chargrams.Model(c, s, np.bincount(at))
    assert sum(len(o[0]) for o in model.orders) > len(s)
    every = np.unique(symbol)
    for one in c[:5]:
        p = np.exp(model.logs(np.full(len(every), one), every))
        unknown = np.exp(model.logs(np.array([one]), np.array([0x4E00])))[0]
        assert abs(p.sum() + (chargrams.ALPHABET - len(every)) * unknown - 1) < 1e-4
