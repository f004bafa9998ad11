"""Text quality by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

import zlib
from collections import Counter
from math import log1p

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.net import fit_pu
from formline.llm.words import text_slices

SAMPLE = 20_000
FEATURES = (
    "log_words word_length distinct_words common_word same_again distinct_lines line_length lower upper digit space stop mark bar"
    " symbol other beyond_ascii shape packed sentence"
).split()


def describe(text: str | None) -> list[float]:
    """Shares and ratios that tell running prose from boilerplate, tables, shouting and loops; all of the text counts."""
    data = (text or "").encode()
    words = data.split()
    n, m = max(1, len(data)), max(1, len(words))
    count = lambda chars: sum(data.count(c) for c in chars)
    lower = n - len(data.translate(None, bytes(range(97, 123)))) if data else 0
    upper = n - len(data.translate(None, bytes(range(65, 91)))) if data else 0
    digit = n - len(data.translate(None, b"0123456789")) if data else 0
    beyond = n - len(data.translate(None, bytes(range(128, 256)))) if data else 0
    space = n - len(data.translate(None, b" \t\n\r\v\f")) if data else 0
    stop, mark, bar = count([b".", b","]), count([b"!", b"?"]), count([b"|"])
    symbol = n - len(data.translate(None, b"#$%&*<>{}[]=_+~^@/\\")) if data else 0
    distinct = set(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    odd = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,")
    return [
        log1p(len(words)), len(data) / m, len(distinct) / m,
        max(Counter(words).values(), default=0) / m,
        again / m, len(set(lines)) / max(1, len(lines)), log1p(len(data) / max(1, len(lines))), lower / n, upper / n, digit / n, space / n,
        stop / m, mark / m, bar / m, symbol / m, (n - lower - upper - digit - space - beyond - stop) / n, beyond / n, odd / m,
        len(zlib.compress(data, 1)) / n, data.count(b".") / max(1, len(lines)),
    ]


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE,
    prior: float | None = None,
):
    """A function from texts to probabilities of quality, learnt from trusted positives and unlabelled texts.

    Trusted positives are rows labelled 1 for which ``learn`` (on the id) holds,
    at most ``sample`` of them, the first in order of a hash of the id. The
    unlabelled texts are about as many rows of the documents, drawn by hash from
    all of them, whatever their labels; if none is drawn, that is an error. Of
    the rows of an id one counts on either side, of rows without an id every text. The class prior, unless given, is
    estimated as the share of 1 among the labels to learn from. Null labels and
    labels of unknown ids teach nothing. Without positives every text gets the
    prior (0.5 without labels).
    """
    import numpy as np

    known = labels.filter(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
    ones, every = known.agg(F.sum("__y"), F.count(F.lit(1))).first()
    if prior is None:
        prior = min(0.95, max(0.05, (ones or 0) / every)) if every else 0.5
    trusted = known.filter("__y = 1").orderBy(F.xxhash64("__id"), "__id").limit(sample).select("__id", F.lit(True).alias("__trusted"))
    share = min(1.0, sample / max(1, docs.count()))
    own = F.xxhash64(F.col(id_col), F.col(text_col))
    mark = F.shiftrightunsigned(own, 1) <= min(2**63 - 1, int(share * 2**63))
    rows = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), own.alias("own"), mark.alias("drawn"))
        .join(F.broadcast(trusted), "__id", "left")  # at most `sample` rows
        .select("__id", "own", "text", "drawn", F.coalesce("__trusted", F.lit(False)).alias("trusted"))
        .filter("drawn or trusted")
    )

    def features(batches):
        import pyarrow as pa

        for batch in text_slices(batches):
            x = [describe(t) for t in batch["text"].to_pylist()]
            named = ["__id", "own", "drawn", "trusted"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in named), pa.array(x, pa.list_(pa.float64()))], [*named, "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    seen = (
        rows.mapInArrow(features, f"__id {kind}, own long, drawn boolean, trusted boolean, x array<double>")
        .groupBy("__id", F.when(F.col("__id").isNull(), F.col("own")).alias("own"))
        .agg(*[F.min(F.when(F.col(c), F.col("x"))).alias(c) for c in ("drawn", "trusted")]).toArrow()
    )

    def ordered(column):
        x = np.array([v for v in seen[column].to_pylist() if v is not None], float).reshape(-1, len(FEATURES))
        return x[np.lexsort(x.T)] if len(x) else x  # rows come in any order

    good, drawn = ordered("trusted"), ordered("drawn")
    if not len(drawn) and not docs.isEmpty():
        raise ValueError(f"no unlabelled text was drawn at a share of {share}")
    net = fit_pu(good, drawn, prior) if len(good) and len(drawn) else None

    def probabilities(texts: list):
        return net.score([describe(t) for t in texts]) if net and texts else np.full(len(texts), prior)

    return probabilities


def quality_scores(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id, score``, the probability that a text is of quality.

    Every text is described and scored whole. Null and empty texts are described
    as texts without words; repeated rows are scored alike; no rows give no rows.
    """
    probabilities = fit_quality(docs, labels, learn, id_col, text_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        import pyarrow as pa

        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(probabilities(batch["text"].to_pylist()), pa.float64())], [id_col, "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"`{id_col}` {kind}, score double")


def keep_quality(docs: DataFrame, labels: DataFrame, learn, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, whose score is at least ``least``. Rows are decided where they are."""
    probabilities = fit_quality(docs, labels, learn, id_col, text_col, **options)

    def keep(batches):
        import pyarrow as pa

        for batch in text_slices(batches, text_col):
            yield batch.filter(pa.array(probabilities(batch[text_col].to_pylist()) >= least, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
