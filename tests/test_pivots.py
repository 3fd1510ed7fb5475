"""Search through an index of pivots: the full product's result, with fewer comparisons."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_operators import brute_force, vectors
from trendloom.operators.latest import top_per_group
from trendloom.operators.pivots import open_index, search_index, write_index

DOCS, ASKED = "id string, embedding array<double>", "question_id string, embedding array<double>"


def found(index, asked, k, **options):
    rows = search_index(index, asked, k, **options)
    hits = top_per_group(rows, ["question_id"], [F.col("similarity").desc(), F.col("id")], k, "place")
    got = {}
    for row in hits.orderBy("place").collect():
        got.setdefault(row.question_id, []).append(row.id)
    return got


def clustered(count, prefix, seed, spread=0.05):
    """Directions around twenty centres; a third of them lie around the first."""
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(99).normal(size=(20, 12))
    rows = []
    for i in range(count):
        near = centres[0 if i % 3 == 0 else rng.integers(20)]
        rows.append((f"{prefix}{i:05d}", [float(x) for x in near + spread * rng.normal(size=12)]))
    return rows


@pytest.mark.parametrize("k, block, values, pivots", [(8, 4096, 1 << 20, 128), (3, 5, 200, 4), (400, 9, 400, 7), (1, 2, 8, 1)])
def test_search_equals_brute_force(spark, folder, k, block, values, pivots):
    """With copies of one vector, vectors of length zero, more neighbours than documents, small parts and groups."""
    documents, questions = vectors(spark, 300, "d", 1), vectors(spark, 25, "q", 2)
    index = write_index(spark.createDataFrame(documents, DOCS), f"{folder}/index", pivots=pivots, part_values=values)
    assert found(index, spark.createDataFrame(questions, ASKED), k, block=block) == brute_force(questions, documents, k)


def test_clustered_documents_are_skipped(spark, folder):
    documents, questions = clustered(6000, "d", 3), clustered(60, "q", 4)
    index = write_index(spark.createDataFrame(documents, DOCS), f"{folder}/index", part_values=12 * 200)
    assert index.rings.agg(F.sum("members")).first()[0] == 6000
    # Parts are even, also those of the cell with a third of all documents.
    sizes = [r["count"] for r in index.rows.groupBy("part").count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 800
    worked = spark.sparkContext.accumulator(0)
    assert found(index, spark.createDataFrame(questions, ASKED), 8, counter=worked) == brute_force(questions, documents, 8)
    assert 0 < worked.value < 0.5 * 6000 * 60


def test_index_is_opened_again(spark, folder):
    documents, questions = clustered(500, "d", 5), clustered(9, "q", 6)
    write_index(spark.createDataFrame(documents, DOCS).withColumn("part", F.lit("x")), f"{folder}/index", pivots=16)
    again = open_index(spark, f"{folder}/index", pivots=16)
    assert found(again, spark.createDataFrame(questions, ASKED), 4) == brute_force(questions, documents, 4)
    with pytest.raises(ValueError):
        open_index(spark, f"{folder}/index", pivots=8)


def test_empty_sides_and_null_vectors(spark, folder):
    docs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], DOCS)
    asked = spark.createDataFrame([("q", [1.0, 1.0]), ("n", None), ("q", [1.0, 1.0])], ASKED)
    assert found(write_index(docs, f"{folder}/one"), asked, 2) == {"q": ["a"]}
    assert found(open_index(spark, f"{folder}/one"), asked.limit(0), 2) == {}
    assert found(write_index(docs.limit(0), f"{folder}/none"), asked, 2) == {}
