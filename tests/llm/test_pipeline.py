"""The stages against plain loops, each on its own input, and the whole run."""

from pathlib import Path

import brute
import pytest

import corpus_pipeline as pipeline
from formline.llm import pu_quality
from formline.llm.words import in_fold

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the corpus tables are not here")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """What each stage reads and returns."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, out[-1], FOLDER).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return [[r.asDict() for r in d.collect()] for d in out]


def test_columns(tables):
    assert all(set(t[0]) == set(tables[0][0]) for t in tables[:-1])


def test_quality(spark, tables):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scores = pu_quality.quality_scores(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), ~in_fold("doc_id")).collect()
    assert {r["doc_id"] for r in tables[1]} == {r.doc_id for r in scores if r.score >= 0.3}


def test_lines(tables):
    clean = brute.clean_lines([(r["doc_id"], r["text"]) for r in tables[1]], 8)
    want = {i: text for i, (_, dropped, text) in clean.items() if not dropped or brute.words(text)}
    assert {r["doc_id"]: r["text"] for r in tables[2]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in tables[2])


def test_near_duplicates(tables):
    groups = brute.groups([(r["doc_id"], r["text"]) for r in tables[2]])
    assert {r["doc_id"] for r in tables[3]} == {i for i, (_, c) in groups.items() if i == c}


def test_benchmark(spark, tables):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in tables[4]} == {r["doc_id"] for r in tables[3] if not brute.hits(r["text"], items, 10)[1]}


def test_mix(tables):
    sizes, taken = {}, {}
    for r in tables[4]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    for r in tables[5]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(brute.words(r["text"]))
    longest = max(len(brute.words(r["text"])) for r in tables[4])
    for s, target in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= longest
    texts = {r["doc_id"]: r["text"] for r in tables[4]}
    assert all(texts[r["doc_id"]] == r["text"] and r["copy"] in (1, 2) for r in tables[5])


def test_run(spark, tables):
    got = sorted((r.doc_id, r.copy, r.text) for r in pipeline.run(spark, FOLDER).collect())
    assert got == sorted((r["doc_id"], r["copy"], r["text"]) for r in tables[5])
