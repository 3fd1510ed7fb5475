"""Exact nearest vectors through an index of pivots, which skips documents by the triangle inequality.

Unit vectors lie on a sphere, where the straight-line distance is a metric that orders documents as
the cosine does. Each document belongs to its nearest pivot (its cell) and is stored with the
distance to it, in parts of bounded size along (cell, distance). A part holds rings: the documents
of one cell between two distances. A question at distance ``d`` from a pivot is at least
``max(d - outer, inner - d)`` away from everything in a ring, so a ring beyond the distance of the
``k`` documents already known is never read. What is left meets as (part, block of questions)
groups; no table of documents or questions is broadcast or passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.operators.latest import top_per_group
from trendloom.operators.settle import settle

PIVOTS = 128
#: Documents from which pivots are chosen, and with which a question is compared first. The sample
#: only decides how much is skipped, never what is found.
SAMPLE = 2048
#: Vector components of a part; 16,384 documents of 64 places.
PART_VALUES = 1 << 20
QUESTIONS_PER_GROUP = 4096
CHUNK_ROWS = 512
#: Similarities are compared to 12 places, which is 1.5e-6 in distance at worst.
SLACK = 1e-5
#: A vector of length zero has similarity 0 to everything, the distance of a right angle.
RIGHT, NO_CELL = math.sqrt(2.0), -1


def unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def unit_rows(column: pd.Series) -> np.ndarray:
    return unit(np.stack(column.to_numpy()).astype(np.float64))


def similarities(documents: np.ndarray, questions: np.ndarray) -> np.ndarray:
    """Rounded, so that equal vectors tie whatever the shape of the product was."""
    return np.round(documents @ questions.T, 12)


def best_of(asked: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` entries of each question with the highest score, lowest id first among equals."""
    order = np.lexsort((ids, -scores, asked))
    asked, scores, ids = asked[order], scores[order], ids[order]
    starts = np.searchsorted(asked, asked, side="left")
    kept = np.arange(len(asked)) - starts < k
    return asked[kept], scores[kept], ids[kept]


def near_entries(table: np.ndarray, ids: np.ndarray, k: int):
    """Entries of a documents x questions table that can be among the best ``k``, ties included."""
    if len(table) > k:
        kth = np.partition(table, len(table) - k, axis=0)[len(table) - k]
        rows, asked = np.nonzero(table >= kth)
    else:
        rows, asked = (x.ravel() for x in np.indices(table.shape))
    return asked, table[rows, asked], ids[rows]


def _distance(similarity: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * similarity))


def _spread(vectors: np.ndarray, most: int) -> np.ndarray:
    """Pivots far from each other: each is the vector farthest from those before it."""
    vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
    if not len(vectors):
        return vectors
    chosen, away = [0], _distance(vectors @ vectors[0])
    while len(chosen) < most and away.max() > SLACK:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distance(vectors @ vectors[chosen[-1]]))
    return vectors[chosen]


@dataclass
class PivotIndex:
    """Stored rows ``(doc_id, vector, cell, away, part)``, rings of the parts, pivots and the sample."""

    rows: DataFrame
    rings: DataFrame
    pivots: np.ndarray
    sample: np.ndarray
    doc_id: str
    vector: str


def _paths(folder: str) -> tuple[str, str, str]:
    return f"{folder}/rows", f"{folder}/rings", f"{folder}/sample"


def write_index(
    corpus: DataFrame, folder: str, doc_id: str = "id", vector: str = "embedding",
    pivots: int = PIVOTS, part_values: int = PART_VALUES,
) -> PivotIndex:
    """Index all rows of ``corpus`` that have a vector, into ``folder`` (shared, new).

    Rows that repeat an id are documents of their own. Many equal vectors are many parts, because
    parts are cut along a hash of the id behind the distance.
    """
    spark = corpus.sparkSession
    documents, n = settle(corpus.filter(F.col(vector).isNotNull()).select(doc_id, vector))
    share = min(1.0, SAMPLE / max(1, n))
    drawn = documents.filter(F.pmod(F.xxhash64(doc_id, F.lit("pivots")), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows_path, rings_path, sample_path = _paths(folder)
    drawn.select(vector).limit(2 * SAMPLE).write.parquet(sample_path)
    sample, centres = _sample(spark, sample_path, vector, pivots)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    placed = documents.mapInPandas(_placer(centres, vector), f"{kinds}, cell int, away double")
    parts = max(1, math.ceil(n * sample.shape[1] / part_values))
    cut = placed.repartitionByRange(parts, "cell", "away", F.xxhash64(doc_id)).withColumn("part", F.spark_partition_id())
    cut.withColumn("pivots", F.lit(pivots)).write.parquet(rows_path)
    rings = spark.read.parquet(rows_path).groupBy("part", "cell").agg(
        F.min("away").alias("inner"), F.max("away").alias("outer"), F.count(F.lit(1)).alias("members")
    )
    rings.withColumn("pivots", F.lit(pivots)).write.parquet(rings_path)
    return open_index(spark, folder, doc_id, vector, pivots)


def open_index(
    spark: SparkSession, folder: str, doc_id: str = "id", vector: str = "embedding", pivots: int = PIVOTS
) -> PivotIndex:
    """The index written into ``folder`` with as many ``pivots``."""
    rows_path, rings_path, sample_path = _paths(folder)
    rings = spark.read.parquet(rings_path)
    if not rings.filter(F.col("pivots") != pivots).isEmpty():
        raise ValueError(f"{folder} was not written with {pivots} pivots")
    sample, centres = _sample(spark, sample_path, vector, pivots)
    return PivotIndex(spark.read.parquet(rows_path).drop("pivots"), rings.drop("pivots"), centres, sample, doc_id, vector)


def _sample(spark: SparkSession, path: str, vector: str, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """The stored sample, in an order of its own, and the pivots among it: the same whenever it is read."""
    held = [r[0] for r in spark.read.parquet(path).select(vector).collect()]
    vectors = unit(np.array(sorted(held), dtype=np.float64)) if held else np.zeros((0, 1))
    return vectors, _spread(vectors, pivots)


def _cells(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return _distance(vectors @ pivots.T) if len(pivots) else np.zeros((len(vectors), 0))


def _placer(pivots: np.ndarray, vector: str):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = unit_rows(batch[vector])
            away = _cells(vectors, pivots)
            cell, nearest = np.full(len(batch), NO_CELL), np.full(len(batch), RIGHT)
            if away.shape[1]:
                turned = np.linalg.norm(vectors, axis=1) > 0
                cell[turned] = away.argmin(axis=1)[turned]
                nearest[turned] = away.min(axis=1)[turned]
            yield batch.assign(cell=cell.astype(np.int32), away=nearest)

    return place


def _bounds(to_pivot: np.ndarray, inner, outer) -> np.ndarray:
    """The least distance to anything in a ring of these distances."""
    return np.maximum(0.0, np.maximum(to_pivot - outer, inner - to_pivot))


def _asker(pivots: np.ndarray, sample: np.ndarray, vector: str, k: int):
    """Distance within which ``k`` documents of the sample lie, and the distances to all pivots."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = unit_rows(batch[vector])
            reach = np.full(len(batch), 2.0)
            if len(sample) >= k:
                table = similarities(sample, vectors)
                reach = _distance(np.partition(table, len(sample) - k, axis=0)[len(sample) - k])
            turned = np.linalg.norm(vectors, axis=1) > 0
            away = _cells(vectors, pivots)
            yield batch.assign(_reach=reach, _turned=turned, _away=list(away))

    return ask


def _compare(index: PivotIndex, k: int, counter: Accumulator | None):
    pivots, doc_id, vector = index.pivots, index.doc_id, index.vector

    def compare(documents: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"_row": asked["_row"][:0], doc_id: documents[doc_id][:0], "similarity": np.zeros(0)})
        if not len(documents) or not len(asked):
            return none
        documents = documents.sort_values(["cell", "away"], kind="stable")
        targets, reach = unit_rows(asked["_vector"]), asked["_reach"].to_numpy().copy()
        turned = asked["_turned"].to_numpy()
        cells, away = documents["cell"].to_numpy(), documents["away"].to_numpy()
        ids, held, done = documents[doc_id].to_numpy(), None, 0
        vectors = unit_rows(documents[vector])
        edges = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
        for first, last in zip(edges[:-1], edges[1:]):
            cell = int(cells[first])
            to_pivot = _distance(targets @ pivots[cell]) if cell != NO_CELL else None
            for at in range(first, last, CHUNK_ROWS):
                upto = min(last, at + CHUNK_ROWS)
                if cell == NO_CELL:
                    least = np.full(len(targets), RIGHT)
                else:
                    least = np.where(turned, _bounds(to_pivot, away[at], away[upto - 1]), RIGHT)
                open_ = np.flatnonzero(least <= reach + SLACK)
                if not len(open_):
                    continue
                done += (upto - at) * len(open_)
                table = similarities(vectors[at:upto], targets[open_])
                which, scores, found = near_entries(table, ids[at:upto], k)
                # What is farther than the k documents already known is no result.
                near = _distance(scores) <= reach[open_[which]] + SLACK
                if not near.any():
                    continue
                found = (open_[which[near]], scores[near], found[near])
                if held is not None:
                    found = tuple(np.concatenate(pair) for pair in zip(held, found))
                held = best_of(*found, k)
                # A question with k documents needs none that is farther than its last.
                numbers, counts = np.unique(held[0], return_counts=True)
                ends = np.cumsum(counts) - 1
                full = counts == k
                reach[numbers[full]] = np.minimum(reach[numbers[full]], _distance(held[1][ends[full]]))
        if counter is not None:
            counter.add(done)
        if held is None:
            return none
        return pd.DataFrame({"_row": asked["_row"].to_numpy()[held[0]], doc_id: held[2], "similarity": held[1]})

    return compare


def search_index(
    index: PivotIndex, questions: DataFrame, k: int = 8, question_id: str = "question_id", vector: str = "embedding",
    block: int = QUESTIONS_PER_GROUP, counter: Accumulator | None = None,
) -> DataFrame:
    """``question_id, doc_id, similarity``: the ``k`` nearest documents of every question vector.

    Each distinct vector is searched once. It is first compared with the sample, then with the part
    of its own cell that is nearest to it, then with all parts that can hold a nearer document than
    the ``k`` found so far; a part hands on only documents within that distance. Null vectors ask
    nothing, a vector of length zero is as near to all, and a question id with several vectors gets
    ``k`` documents for each. ``counter`` adds up the similarities that were worked out.
    """
    questions = settle(questions.filter(F.col(vector).isNotNull()).select(question_id, F.col(vector).alias("_asked")).distinct())[0]
    kind, id_kind = (df.schema[name].dataType.simpleString() for df, name in ((questions, "_asked"), (index.rows, index.doc_id)))
    asked = questions.select(F.col("_asked").alias("_vector")).distinct().mapInPandas(
        _asker(index.pivots, index.sample, "_vector", k), f"_vector {kind}, _reach double, _turned boolean, _away array<double>"
    )
    # Stored with its number, so the number of a vector never changes.
    asked, count = settle(asked.withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, math.ceil(count / block))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    found_kind = f"_row long, `{index.doc_id}` {id_kind}, similarity double"
    compare = _compare(index, k, counter)

    def visit(pairs: DataFrame, known: DataFrame) -> DataFrame:
        """Compare questions with parts, given as ``(_row, _block, part)``."""
        # Under names of their own: both sides of a cogroup must not share columns.
        groups = pairs.select("part", F.col("_block").alias("_group")).distinct()
        left = index.rows.join(groups, "part").groupBy("part", "_group")
        right = pairs.join(known, ["_row", "_block"]).select("part", "_block", "_row", "_vector", "_reach", "_turned")
        return settle(left.cogroup(right.groupBy("part", "_block")).applyInPandas(compare, found_kind))[0]

    right_angle = ~F.col("_turned") | (F.col("cell") == NO_CELL)
    least = F.when(right_angle, F.lit(RIGHT)).otherwise(
        F.greatest(F.lit(0.0), F.col("_to") - F.col("outer"), F.col("inner") - F.col("_to"))
    )
    in_reach = F.col("_least") <= F.col("_reach") + SLACK
    whole = index.rings.groupBy("cell").agg(F.min("inner").alias("inner"), F.max("outer").alias("outer"))

    def rings_in_reach(of: DataFrame) -> DataFrame:
        """Whole cells out of reach go first, so that only cells in reach are opened into rings."""
        bare = ["_row", "_block", "_reach", "_turned"]
        cells = of.select(*bare, F.posexplode("_away").alias("cell", "_to")).unionByName(
            of.select(*bare, F.lit(NO_CELL).alias("cell"), F.lit(0.0).alias("_to"))
        )
        cells = cells.join(whole, "cell").withColumn("_least", least).filter(in_reach).drop("inner", "outer", "_least")
        return cells.join(index.rings, "cell").withColumn("_least", least).filter(in_reach)

    home = rings_in_reach(asked).groupBy("_row", "_block").agg(
        F.min_by("part", F.struct("_least", "_to", "part")).alias("part")
    )
    home = settle(home)[0]
    first = visit(home, asked)
    last = top_per_group(first, ["_row"], [F.col("similarity").desc()], k, "_place").groupBy("_row").agg(
        F.count(F.lit(1)).alias("_n"), F.min("similarity").alias("_kth")
    )
    closer = F.when(F.col("_n") == k, F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("_kth"))))
    known = asked.join(last, "_row", "left").withColumn("_reach", F.least("_reach", closer)).drop("_n", "_kth")
    known = settle(known)[0]
    rest = rings_in_reach(known).select("_row", "_block", "part").distinct()
    rest = settle(rest.join(home, ["_row", "_block", "part"], "left_anti"))[0]
    found = first.unionByName(visit(rest, known))
    best = top_per_group(found, ["_row"], [F.col("similarity").desc(), F.col(index.doc_id)], k, "_place")
    named = questions.join(asked.select("_row", "_vector"), F.col("_asked") == F.col("_vector")).select(question_id, "_row")
    return named.join(best, "_row").select(question_id, index.doc_id, "similarity")
