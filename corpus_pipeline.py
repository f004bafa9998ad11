"""From raw documents to a training mix: five stages, each written as Parquet and read again.

Null texts pass as empty ones where a stage says so; a table without rows passes
through all stages. Columns besides those of the documents, if any, are carried on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import decontaminate, lines, minhash, mixing, pu_quality
from formline.llm.words import in_fold
from formline.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for quality text (score of 0.3 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality.keep_quality(docs, labels, ~in_fold("doc_id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in an earlier one; those with no line left go. n_chars follows the text."""
    kept = lines.drop_duplicate_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 80 % or more."""
    return minhash.drop_near_duplicates(docs, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; ``copy`` counts from 1."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix", mix),
]

#: SQL can't express the learnt stage; tests compare the others, and the whole, with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. Results between stages stay below the checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        path = f"{folder}/{number}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
