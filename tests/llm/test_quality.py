"""Quality describes whole texts, and never goes on without a drawn text."""

import pytest
from pyspark.sql import functions as F

from formline.llm import pu_quality


def test_common_word_counts_the_whole_text():
    at = pu_quality.FEATURES.index("common_word")
    assert pu_quality.describe("one two three " + "spam " * 97)[at] == 0.97


def test_draws_among_many_rows(spark, make_docs, monkeypatch):
    """A share of 2e-14 draws none of 40 rows, which is an error and not a constant score."""
    docs = make_docs([(i, f"text number {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    monkeypatch.setattr(type(docs), "count", lambda self: 50_000_000_000_000)
    with pytest.raises(ValueError, match="drawn"):
        pu_quality.fit_quality(docs, labels, F.lit(True), sample=1)
