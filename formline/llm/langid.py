"""Language identification by character models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.chargrams import count_grams, distinct, grams
from formline.llm.chargrams import models as models_of
from formline.llm.charlm import slices
from formline.llm.words import text_slices
from formline.session import reliable_checkpoint

UNKNOWN = "und"


def entropies(texts: list[str], models: list):
    """Cross-entropy per symbol of each text under each language (rows of zeros for texts without a letter), and symbols."""
    import numpy as np

    context, symbol, ends = grams(texts)
    n = np.diff(ends)
    sums = np.zeros((len(texts), len(models)))
    full = np.flatnonzero(n > 0)
    if len(full):
        context, symbol, at = distinct(context[ends[0] : ends[-1]], symbol[ends[0] : ends[-1]])
        logs = np.column_stack([m.logs(context, symbol) for m in models])[at]
        sums[full] = np.add.reduceat(logs, ends[:-1][full] - ends[0], axis=0)
    return -sums / np.maximum(n, 1)[:, None], n


def identify(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", accepted: float = 0.999,
    sharpness: int = 40,
) -> DataFrame:
    """One row per document: ``id, lang_pred, score, cross_entropy, confident``.

    One model per language is counted over every row for which ``learn`` holds
    and the language isn't null, whole texts. Each document gets the language
    with the lowest cross-entropy per symbol, the first in order among equals.
    ``score`` is that language's share of exp(-cross-entropy * symbols), symbols
    counted up to ``sharpness``. ``confident`` is the calibrated rejection: false
    where the text fits worse than all but ``accepted`` of the learning texts fit
    their own language, or where the language is unknown.

    Null texts and texts without a letter are ``und`` with score 0. With no row to
    learn from, all are. Repeated rows are scored alike. The models have a number
    per distinct run of symbols, so they grow with the corpus; the driver and
    each task hold them.
    """
    known = docs.filter(learn & F.col(lang_col).isNotNull())
    models = models_of(count_grams(known, lang_col, text_col))
    languages = sorted(models)
    held = known.sparkSession.sparkContext.broadcast([models[x] for x in languages])
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        import numpy as np
        import pyarrow as pa

        ordered = held.value
        for batch in text_slices(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in slices(texts):
                best, share, level = [UNKNOWN] * (b - a), np.zeros(b - a), [None] * (b - a)
                if languages:
                    h, n = entropies(texts[a:b], ordered)
                    n[[i for i in np.flatnonzero(n) if not any(map(str.isalpha, texts[a + i]))]] = 0  # marks alone are no letters
                    first = h.argmin(axis=1)
                    low = h[np.arange(b - a), first]
                    share = 1 / np.exp((low[:, None] - h) * np.minimum(n, sharpness)[:, None]).sum(axis=1)
                    share[n == 0] = 0
                    for i in np.flatnonzero(n):
                        best[i], level[i] = languages[first[i]], float(low[i])
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(a, b - a), batch["learn"].slice(a, b - a), batch["lang"].slice(a, b - a), pa.array(best), pa.array(share), pa.array(level, pa.float64())],
                    ["id", "learn", "lang", "lang_pred", "score", "cross_entropy"],
                )

    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(lang_col).cast("string").alias("lang")
    )
    scored = reliable_checkpoint(
        rows.mapInArrow(score, f"id {kind}, learn boolean, lang string, lang_pred string, score double, cross_entropy double")
    )
    limits = scored.filter("learn and lang = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", F.lit(accepted), 10_000).alias("limit")
    )
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(  # a row per language learnt
        F.col("id").alias(id_col), "lang_pred", "score", "cross_entropy",
        F.coalesce(F.col("cross_entropy") <= F.col("limit"), F.lit(False)).alias("confident"),
    )
