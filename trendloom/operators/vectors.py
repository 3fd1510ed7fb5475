"""Exact nearest vectors by cosine distance."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators.latest import top_per_group
from trendloom.operators.pivots import best_of, near_entries, search_index, similarities, unit, unit_rows, write_index
from trendloom.operators.settle import settle
from trendloom.session import scratch_root

#: Question vectors that are sent to all tasks; more are searched through an index.
QUESTIONS_PER_BLOCK = 4096
BLOCK_ROWS = 1024
_unit = unit


def cosine_topk(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = 8,
    question_id: str = "question_id",
    doc_id: str = "id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    details: DataFrame | None = None,
    block: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """The ``k`` nearest documents of every question: question, id, similarity, distance, place.

    Question vectors are stored once and counted. Up to ``block`` of them go to the documents: each
    task multiplies its document batches with them and hands on its own best ``k`` per question, so
    neither pairs nor documents are shuffled. More of them go through a :mod:`pivot index
    <trendloom.operators.pivots>` of the documents. A question id with several vectors has one list,
    of the documents that are nearest to any of them. ``carry`` names columns to look up for the
    hits, in ``details`` or else in the corpus.
    """
    spark = corpus.sparkSession
    asked, count = settle(questions.select(question_id, vector).filter(F.col(vector).isNotNull()))
    documents = corpus.filter(F.col(vector).isNotNull()).select(doc_id, vector)
    if count <= block:
        rows = asked.collect()
        part = [r[0] for r in rows], unit(np.array([r[1] for r in rows], dtype=np.float64)) if rows else None
        types = {f.name: f.dataType.simpleString() for f in corpus.schema.fields}
        kinds = (
            f"`{question_id}` {asked.schema[question_id].dataType.simpleString()}, `{doc_id}` {types[doc_id]}, "
            "similarity double"
        )
        found = documents.mapInPandas(_searcher(spark.sparkContext.broadcast(part), k, question_id, doc_id, vector), kinds)
    else:
        index = write_index(documents, f"{scratch_root(spark)}/pivots-{uuid.uuid4().hex}", doc_id, vector)
        found = search_index(index, asked, k, question_id, vector, block)
    if not asked.groupBy(question_id).count().filter("count > 1").isEmpty():
        # The vectors of an id share one list, in which a document stands once, with its best similarity.
        found = found.groupBy(question_id, doc_id).agg(F.max("similarity").alias("similarity"))
    order = [F.col("similarity").desc(), F.col(doc_id)]
    hits = top_per_group(found, [question_id], order, k, "place").withColumn(
        "distance", F.lit(1.0) - F.col("similarity")
    )
    if carry:
        source = corpus if details is None else details
        hits = source.select(doc_id, *carry).join(hits, doc_id)
    return hits


def _searcher(sent, k: int, question_id: str, doc_id: str, vector: str):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, targets = sent.value
        held = None
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS) if keys else ():
                block = batch.iloc[start : start + BLOCK_ROWS]
                table = similarities(unit_rows(block[vector]), targets)
                found = near_entries(table, block[doc_id].to_numpy(), k)
                if held is not None:
                    found = tuple(np.concatenate(pair) for pair in zip(held, found))
                held = best_of(*found, k)
        if held is not None:
            asked, scores, ids = held
            yield pd.DataFrame({question_id: [keys[i] for i in asked], doc_id: ids, "similarity": scores})

    return search
