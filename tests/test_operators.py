import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendloom.operators.latest import first_seen, newest_per_key, top_per_group
from trendloom.operators.numbering import number_rows
from trendloom.operators.ranking import in_ranges, leaders, rank_by_score, score_band, score_histogram
from trendloom.operators.vectors import cosine_topk


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- newest per key ---------------------------------------------------------------------


def test_newest_version_wins(spark):
    rows = [
        ("k7", "draft", "2024-03-05T08:00:00"),
        ("k7", "final", "2024-03-05T09:30:00"),
        ("k8", "single", "2024-03-04T23:59:59"),
    ]
    df = spark.createDataFrame(rows, "unified_id string, title string, ingested_at string")
    kept = {r.unified_id: r.title for r in newest_per_key(df, "unified_id").collect()}
    assert kept == {"k7": "final", "k8": "single"}


def test_equal_stamps_leave_one_row_whatever_the_order(spark):
    rows = [("a", f"t{i}", "2024-01-01") for i in range(50)] + [("a", None, None)]
    results = set()
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, title string, at string").repartition(4)
        kept = newest_per_key(df, "k", "at").collect()
        assert len(kept) == 1
        results.add(kept[0].title)
    assert results == {"t9"}


def test_newest_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as ingested_at")
    plan = final_plan(newest_per_key(df, "k"))
    assert plan.count("WindowGroupLimit") == 2


def test_first_seen_prefers_slices_and_skips_known(spark):
    rows = [(1, "go", 2), (1, "all", 1), (2, "go", 2), (3, "all", 1), (None, "all", 1)]
    df = spark.createDataFrame(rows, "id int, slice string, place int")
    seen = spark.createDataFrame([(3,)], "id int")
    got = sorted((r.id, r.slice) for r in first_seen(df, "id", [F.col("place")], seen).collect())
    assert got == [(1, "all"), (2, "go")]


def test_top_per_group_keeps_place(spark):
    df = spark.range(10).selectExpr("id % 2 as g", "id")
    got = top_per_group(df, ["g"], [F.col("id").desc()], 2, "place").collect()
    assert sorted((r.g, r.id, r.place) for r in got) == [(0, 6, 2), (0, 8, 1), (1, 7, 2), (1, 9, 1)]


# ---- ranks ------------------------------------------------------------------------------


def scored(spark, rows, seed=1):
    """A hot group with a third of the rows, hot ties, nulls, negative and tiny scores."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        group = None if i % 11 == 0 else "hot" if i % 3 == 0 else f"g{rng.randrange(20)}"
        kind = rng.randrange(6)
        score = (
            None if kind == 0 else 11.0 if kind == 1 else float(rng.randrange(-20, 50)) if kind == 2
            else rng.uniform(-5, 5) if kind == 3 else rng.uniform(0, 1e7) if kind == 4 else rng.random() / 1e6
        )
        data.append((i, group, score))
    return spark.createDataFrame(data, "id int, grp string, score double").repartition(5)


def test_score_band_never_falls(spark):
    rng = random.Random(3)
    values = sorted(rng.choice((-1, 1)) * 10 ** rng.uniform(-12, 300) for _ in range(3000))
    df = spark.createDataFrame([(v,) for v in values], "score double")
    bands = [r.b for r in df.orderBy("score").select(score_band(F.col("score")).alias("b")).collect()]
    assert bands == sorted(bands)


@pytest.mark.parametrize("rows", [0, 5, 3000])
def test_rank_by_score_equals_the_window(spark, rows):
    df = scored(spark, rows)
    window = Window.partitionBy("grp").orderBy(F.col("score").desc())
    want = {r.id: r.r for r in df.withColumn("r", F.rank().over(window)).collect()}
    got = {r.id: r.r for r in rank_by_score(df, ["grp"], "score", "r").collect()}
    assert got == want


@pytest.mark.parametrize(("rows", "k"), [(5, 50), (3000, 3), (3000, 50)])
def test_leaders_equal_the_windows(spark, rows, k):
    df = scored(spark, rows)
    ranked = df.withColumns({
        "overall": F.rank().over(Window.orderBy(F.col("score").desc())),
        "place": F.rank().over(Window.partitionBy("grp").orderBy(F.col("score").desc())),
    })
    want = {r.id: (r.place, r.overall) for r in ranked.filter(F.col("place") <= k).collect()}
    got = {r.id: (r.place, r.overall) for r in leaders(df, "grp", "score", k, "place", "overall").collect()}
    assert got == want


def test_number_rows_equals_one_sorted_list(spark):
    df = scored(spark, 500)
    numbered = number_rows(df, "grp", [F.col("score").desc_nulls_last(), F.col("id")], "n")
    got = [r.id for r in sorted(numbered.collect(), key=lambda r: r.n)]
    order = [F.col("grp").asc_nulls_first(), F.col("score").desc_nulls_last(), F.col("id")]
    assert got == [r.id for r in df.orderBy(*order).collect()]
    assert sorted(r.n for r in numbered.collect()) == list(range(500))


# ---- nearest vectors --------------------------------------------------------------------


def vectors(spark, count, prefix, seed):
    rng = np.random.default_rng(seed)
    rows = [(f"{prefix}{i:04d}", [float(x) for x in rng.normal(size=8)]) for i in range(count)]
    # A third of the documents are copies of one vector, and one has no direction.
    rows = [(i, rows[0][1]) if n % 3 == 0 else (i, v) for n, (i, v) in enumerate(rows)]
    return rows + [(f"{prefix}zero", [0.0] * 8)]


def brute_force(questions, documents, k):
    def unit(v):
        v = np.array(v)
        return v / np.linalg.norm(v) if np.linalg.norm(v) else v

    best = {}
    for q, qv in questions:
        scores = sorted((-round(float(unit(qv) @ unit(dv)), 12), d) for d, dv in documents)
        best[q] = [d for _, d in scores[:k]]
    return best


def test_tied_topics_collapse_before_any_window(spark):
    """200,000 rows of one hour with one score: a few rows per task reach the windows."""
    df = spark.range(200_000, numPartitions=8).selectExpr("id", "'h' as grp", "0.0D as score")
    got = rank_by_score(df, ["grp"], "score", "r")
    plan = score_histogram(df, ["grp"], "score")
    assert plan.count() == 1 and got.filter("r = 1").count() == 200_000
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window") < text.index("Aggregate")  # windows stand above the counts


def test_a_week_of_seconds_is_several_ranges(spark):
    week = spark.range(604_800).selectExpr("(1.7e9D + id) / 1e9D as score")
    sizes = [r["count"] for r in in_ranges(week, [F.col("score").desc()]).groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * 604_800 / len(sizes)


@pytest.mark.parametrize("limit", [4096, 7])
def test_cosine_topk_equals_brute_force(spark, limit):
    documents, questions = vectors(spark, 300, "d", 1), vectors(spark, 25, "q", 2)
    corpus = spark.createDataFrame(documents, "id string, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(questions, "question_id string, embedding array<double>")
    got = {}
    for row in cosine_topk(asked, corpus, 8, block=limit).orderBy("place").collect():
        got.setdefault(row.question_id, []).append(row.id)
        assert row.distance == pytest.approx(1 - row.similarity)
    assert got == brute_force(questions, documents, 8)


def test_cosine_topk_with_few_documents_and_no_questions(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id int, embedding array<float>")
    one = spark.createDataFrame([("q", [1.0, 1.0])], "question_id string, embedding array<float>")
    assert [(r.id, r.place) for r in cosine_topk(one, corpus).collect()] == [(1, 1)]
    assert cosine_topk(one.limit(0), corpus).count() == 0
