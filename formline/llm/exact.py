"""Exact de-duplication by content hash, bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.words import ascii_lower


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row with the id that its group of equal texts keeps.

    Texts are equal when they are the same after lower-casing A-Z. ``keep`` says
    whether the smallest or the largest id stays. The group key is a 128-bit
    hash together with the normalised text, so the aggregation itself compares
    the bytes of texts with equal hashes: texts that collide form groups of their
    own. It combines on the map side, so a text that a third of all rows share
    sends one row per task. Rows find their group again by that hash and SHA-256,
    without their texts.

    Returns ``id, keep_id, group_size, kept, text_sha256``. Null texts are empty
    texts. A null id never wins against another; in a group of null ids only,
    keep_id is null and the rows are kept. Rows that repeat an id and a text all
    carry the flag of that id. No rows give no rows.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(F.col(id_col), norm.alias("__norm")).select(
        id_col, "__norm", F.unhex(F.md5("__norm")).alias("__h"), F.sha2("__norm", 256).alias("text_sha256")
    )
    groups = (
        base.groupBy("__h", "__norm")
        .agg(best(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("__h", F.sha2("__norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    return base.drop("__norm").join(groups, ["__h", "text_sha256"]).select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns: those whose id is the keep_id of their group."""
    marked = exact_groups(docs, id_col, text_col, keep).filter("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")
    ).distinct()
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    return docs.join(marked, F.col(id_col).eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_semi")
