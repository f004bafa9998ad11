import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs, with further columns whose names the operators use themselves."""

    def make(pairs):
        rows = [(i, t, "en", "s", 1, True, 0.5, 3, 4, "k", "x", 7) for i, t in pairs]
        return spark.createDataFrame(
            rows,
            "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, n_words long, size long,"
            " text_key string, id string, copy long",
        )

    return make


EDGES = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, "one"), (5, "one"), (None, "a b c d e f g h i j k"), (None, "other words stand here"), (6, "same text of six words here"),
    (6, "same text of six words here"), (7, "Same TEXT of six words here"), (8, "wordy " * 50_000), (9, "É é " * 40), (10, "1 2 3 !!! ###"),
]


@pytest.fixture
def edges():
    return EDGES
