"""Language, toxicity and quality on held-out rows, and the models they rest on."""

from pathlib import Path

import numpy as np
import pytest

from formline.llm import charlm, net, queries

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the corpus tables are not here")


def test_cells_of_a_text_depend_on_it_alone():
    texts = ["Hello world", "", "¡é! 12", "a-b", " end "]
    found, ends = charlm.cells(texts)
    for i, t in enumerate(texts):
        alone, own = charlm.cells([t])
        assert found[ends[i] : ends[i + 1]].tolist() == alone[own[0] : own[1]].tolist()
    assert ends[2] - ends[1] == 0 and ends[4] - ends[3] == 4


def test_probabilities_sum_to_one():
    found, ends = charlm.cells(["the cat sat on the mat"] * 3 + ["then others came"])
    counts = np.bincount(found, minlength=charlm.CELLS).astype(float)
    for p in (charlm.kneser_ney(counts), charlm.kneser_ney(counts, counts * 2, 2)):
        assert p.min() > 0 and np.allclose(p.reshape(-1, charlm.SYMBOLS).sum(axis=1), 1)


def test_positive_unlabelled_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (3000, 3)), rng.normal(-1, 0.5, (1000, 3))
    model = net.fit_pu(good[:1000], np.concatenate([good[1000:], bad]), prior=2 / 3, steps=400)
    assert (model.score(good) > 0.5).mean() > 0.97 and (model.score(bad) < 0.5).mean() > 0.97


@needs_tables
def test_language(spark):
    rows = queries.QUERIES["op9_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    held = rows.filter("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


@needs_tables
@pytest.mark.parametrize("name, label, least", [("op2_toxicity", "toxic", 0.9), ("op5_quality_classifier", "quality", 0.97)])
def test_ranking_of_held_out_rows(spark, name, label, least):
    rows = queries.QUERIES[name](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = rows.filter("held_out").join(truth, "doc_id").collect()
    pairs = [(a.score, b.score) for a in held if a[label] == 1 for b in held if b[label] == 0]
    assert np.mean([(x > y) + 0.5 * (x == y) for x, y in pairs]) > least
    again = {r.doc_id: r.score for r in queries.QUERIES[name](spark, FOLDER).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in held)
