"""The corpus pipeline: documents in, the mix to train on out.

Each stage takes what the one before kept, decides about all of it and returns the rows
that stay, with the columns of ``documents``. The last one adds to each document the
words that the mix takes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.llm.common import stored, table
from rivermark.llm.decontaminate import decontaminate
from rivermark.llm.exact_dedup import without_exact_duplicates
from rivermark.llm.mixing import mix
from rivermark.llm.near_dedup import without_near_duplicates
from rivermark.llm.quality import fold, quality_model, with_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    It learns from the labels of ``labels`` whose crc32 modulo 3 isn't 1.
    """
    model = quality_model(docs, table(spark, sf_dir, "labels"), usable=fold(F.col("id"), 3) != 1)
    score = "quality_score"
    while score in docs.columns:
        score += "_"
    return with_quality(docs, model, name=score).filter(F.col(score) >= 0.5).drop(score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return without_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it.

    An input column named like one of the mix's is replaced by it.
    """
    own = ("doc_id", "size", "source_size", "target", "taken")
    return mix(docs, keep=[c for c in docs.columns if c not in own])


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# SQL can't say what the classifier or the signatures find; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
