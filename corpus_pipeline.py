"""A training corpus from raw documents, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. Its result is written to the
shared folder and read again as the next stage's documents, so a lost executor repeats no stage.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import decontamination, exact_dedup, near_dedup, pieces, quality
from trendloom.llm.shared import table
from trendloom.session import scratch_root

#: No SQL: the first stage is a trained classifier. Stages are tested against brute force instead.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_repeats(docs, exact_dedup.early_half(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than one word in twenty."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document under merge-dropout, with a check that they decode to the text."""
    return pieces.transcode(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(kept.schema).parquet(f"{folder}/{k}")
    return docs
