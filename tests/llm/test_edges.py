"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names for every operator."""

import pytest
from pyspark.sql import functions as F

from formline.llm import decontaminate, exact, fim, langid, lines, minhash, mixing, pu_quality, substrings, toxicity, warc
from formline.llm.words import in_fold, word_count



def learn():
    return ~in_fold("doc_id")



def labelled(spark, rows=((4, 1, 0), (6, 0, 1), (10, None, None), (99, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def items(spark, rows=((1, "same text of six words here"), (2, None), (None, "a b c"), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "substrings": lambda s, d: substrings.repeated_passages(d),
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, labelled(s), learn()),
    "decontaminate": lambda s, d: decontaminate.contamination(d, items(s)),
    "decontaminate_joined": lambda s, d: decontaminate.contamination(d, items(s), max_broadcast=0, max_hits=0),
    "lines": lambda s, d: lines.duplicate_lines(d),
    "quality": lambda s, d: pu_quality.quality_scores(d, labelled(s), learn()),
    "mixing": lambda s, d: mixing.mix_plan(d.select("doc_id", "source", word_count(F.col("text")).alias("size")), ["doc_id"]),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "exact": lambda s, d: exact.exact_groups(d),
    "langid": lambda s, d: langid.identify(d, learn()),
    "warc": lambda s, d: warc.as_records(d, "doc_id", "source", "text"),
    "fim": lambda s, d: fim.fill_in_middle(d),
    "fim_words": lambda s, d: fim.fill_in_middle(d, unit="word", plain_percent=0, spm_percent=100),
}
FILTERS = {
    "exact": lambda s, d: exact.drop_exact(d),
    "lines": lambda s, d: lines.drop_duplicate_lines(d),
    "minhash": lambda s, d: minhash.drop_near_duplicates(d),
    "quality": lambda s, d: pu_quality.keep_quality(d, labelled(s), learn()),
    "decontaminate": lambda s, d: decontaminate.drop_contaminated(d, items(s)),
    "mixing": lambda s, d: mixing.mixed(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each(spark, make_docs, edges, name):
    rows = OPERATORS[name](spark, make_docs(edges)).collect()
    assert len(rows) == len(edges)
    assert OPERATORS[name](spark, make_docs([])).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(spark, make_docs, edges, name):
    docs = make_docs(edges)
    out = FILTERS[name](spark, docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert {r.doc_id for r in out.collect()} <= {i for i, _ in edges}
    assert FILTERS[name](spark, make_docs([])).collect() == []


def test_values_on_edges(spark, make_docs, edges):
    docs = make_docs(edges)
    und = {r.doc_id for r in langid.identify(docs, learn()).collect() if r.lang_pred == "und"}
    assert und == {1, 2, 3, 10}
    marks = docs.unionByName(make_docs([(20, "\u0301\u0302"), (21, " \u0301 1"), (22, "e\u0301")]))
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(marks, learn()).collect() if (r.doc_id or 0) in (20, 21)} == {(20, "und", 0.0), (21, "und", 0.0)}
    groups = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 6, False), (None, None, True)} <= groups
    same = {(r.doc_id, r.keep_id, r.group_size) for r in exact.exact_groups(docs).collect()}
    assert {(1, 1, 2), (2, 1, 2), (4, 4, 2), (5, 4, 2), (6, 6, 3), (7, 6, 3)} <= same
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, items(spark)).collect() if r.doc_id}
    assert found[6] == (6, 6, ["1"]) and found[7] == (6, 6, ["1"]) and found[1] == (0, 0, []) and found[8] == (50_000, 0, [])
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity_scores(docs, labelled(spark), learn()).collect())


def test_learning_from_nothing(spark, make_docs, edges):
    docs, none = make_docs(edges), labelled(spark, [])
    assert {r.score for r in toxicity.toxicity_scores(docs, none, learn()).collect()} == {0.0}
    assert {r.score for r in pu_quality.quality_scores(docs, none, learn()).collect()} == {0.5}
    assert {r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
    assert {r.n_hit for r in decontaminate.contamination(docs, items(spark, [])).collect()} == {0}
