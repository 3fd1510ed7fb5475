"""Registered queries of the training-data operators: each over its whole table, with a narrow result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import (
    ball_codes, bloom_lm, decontamination, exact_dedup, importance, licenses, mixing, near_dedup, pieces, quality, repeats, urls, warc,
)
from trendloom.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents under merge-dropout, decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.transcode(docs, ids=False).drop("text")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that documents are, and that their lines name."""
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls, by rules and path templates."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents; the older half of the ids is the history."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs, exact_dedup.early_half(docs))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labelled ones."""
    docs, labels, pages = (table(spark, sf_dir, name) for name in ("documents", "labels", "pages"))
    return quality.score_quality(docs, labels, pages)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, indexed, and read back."""
    return warc.archive_and_read(table(spark, sf_dir, "pages")).drop("url", "html")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of nine tenths of them."""
    scored = bloom_lm.learn_and_score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select(
        "doc_id", "held_out", "lm.n_tokens", "lm.n_known", "train_tokens", "lm.base_score", "lm.score"
    )


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes in all documents, taken out."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents, with the longest match of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judge(decontamination.find_benchmark(docs, table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        "found.longest_words", F.coalesce("found.longest_at", F.lit(-1)).alias("longest_at"), "found.longest_item",
    )


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each, by the weights of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as codes of 16 parts."""
    return ball_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_license_scans, op3_url_filters, op4_minhash_near_dedup,
        op5_exact_dedup, op6_quality_classifier, op7_warc, op8_lm_scoring, op9_suffix_array_dedup, op10_benchmark_decontamination,
        op11_source_mixing, op12_importance_resampling, op13_vector_codes,
    )
}
