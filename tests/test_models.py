"""Models that falter or are down, and answers that are kept."""

import json
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from tests.test_enrich import TEXT, silver_row
from tests.test_retrieval import letters
from trendloom.operators.memory import remembered
from trendloom.operators.models import NOT_ASKED, respond
from trendloom.operators.vectors import cosine_topk
from trendloom.plans import enrich, jobs, retrieval
from trendloom.schemas import SILVER_SCHEMA
from trendloom.sources.tables import TableStore

AT = datetime(2024, 1, 15)


def counting(log, bad=()):
    """A model that notes each text it gets, and refuses some."""
    def factory():
        def answer(text):
            with open(log, "a") as file:
                file.write(f"{text}\n")
            if any(word in text for word in bad):
                raise RuntimeError("refused")
            return json.dumps({"sentiment": "positive", "ai_topics": [text[:1]]})
        return answer
    return factory


def calls(log):
    try:
        return Counter(open(log).read().split("\n")[:-1])
    except FileNotFoundError:
        return Counter()


def asked(spark, texts, factory, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").coalesce(1)
    got = rows.withColumn("a", respond(factory, F.col("t"), **options)).collect()
    return {r.n: (r.a.raw is not None, r.a.failure) for r in got}


def test_retries_until_the_model_answers(spark, folder):
    def failing(times):
        def factory():
            left = {}

            def answer(text):
                left[text] = left.get(text, times) - 1
                if left[text] >= 0:
                    raise RuntimeError(f"{left[text]} left")
                return "{}"
            return answer
        return factory

    assert asked(spark, ["a", None, "b"], failing(2), retries=2, backoff_seconds=0) == {0: (True, None), 1: (False, None), 2: (True, None)}
    assert asked(spark, ["a"], failing(3), retries=2, backoff_seconds=0.001) == {0: (False, "0 left")}
    assert asked(spark, ["a"], failing(1)) == {0: (False, "0 left")}


def test_the_breaker_stops_asking(spark, folder):
    log = f"{folder}/calls"
    texts = ["ok", "bad 1", "ok 2", "bad 2", "bad 3", "bad 4", "ok 3"]
    got = asked(spark, texts, counting(log, ["bad"]), breaker=2)
    assert got == {0: (True, None), 1: (False, "refused"), 2: (True, None), 3: (False, "refused"), 4: (False, "refused"), 5: (False, NOT_ASKED), 6: (False, NOT_ASKED)}
    assert calls(log) == Counter(texts[:5])


def test_rows_that_were_not_asked_are_candidates_again(spark, folder):
    store = TableStore(spark, folder, "parquet")
    store.upsert(spark.createDataFrame([silver_row(f"u{i}", f"title {i}", i) for i in range(6)], SILVER_SCHEMA), "silver", "hn", "unified_id")
    down = counting(f"{folder}/down", ["title"])
    assert jobs.run_enrichment(store, down, "m", parallel_calls=1, breaker=2) == 2  # two failed, four were not asked
    assert sum(calls(f"{folder}/down").values()) == 2
    up = counting(f"{folder}/up")
    assert jobs.run_enrichment(store, up, "m", parallel_calls=1, breaker=2) == 4
    assert jobs.run_enrichment(store, up, "m", parallel_calls=1, retry_errors=True) == 2
    assert sum(calls(f"{folder}/up").values()) == 6
    assert store.read("silver", "enriched").filter(F.col("enrichment_error") == NOT_ASKED).isEmpty()


def test_a_text_is_asked_once_over_two_runs(spark, folder):
    store, log = TableStore(spark, folder, "parquet"), f"{folder}/calls"
    rows = lambda *titles: spark.createDataFrame([(str(i), "s", t, None, 1) for i, t in enumerate(titles)], TEXT)
    run = lambda df, model="m": {r.unified_id: (r.sentiment, r.enrichment_error) for r in enrich.enrich(df, counting(log, ["bad"]), model, memory=store).collect()}
    good, refused = ("positive", None), ("neutral", "refused")
    assert run(rows("a", "b", "a", " ", "bad")) == {"0": good, "1": good, "2": good, "3": ("neutral", "empty_title"), "4": refused}
    assert calls(log) == Counter({"a. ": 1, "b. ": 1, "bad. ": 1})
    assert run(rows("b", "c", "bad", "a")) == {"0": good, "1": good, "2": refused, "3": good}
    assert calls(log) == Counter({"a. ": 1, "b. ": 1, "c. ": 1, "bad. ": 2})  # a failure is not kept
    run(rows("a"), "other")
    assert calls(log)["a. "] == 2


def test_vectors_are_kept_over_rebuilds(spark, folder):
    store, log = TableStore(spark, folder, "parquet"), f"{folder}/calls"

    def noting():
        def encode(texts):
            with open(log, "a") as file:
                file.writelines(f"{t}\n" for t in texts)
            return letters()(texts)
        return encode

    docs = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for texts in (("ab", "ab", None, "c"), ("c", "ab", "", "dd", None)):
        got = retrieval.embed_remembered(docs(*texts), store, "letters", noting).collect()
        want = retrieval.embed_documents(docs(*texts), letters).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert calls(log) == Counter(["ab", "", "c", "dd"])
    empty = remembered(docs("x").limit(0), F.col("text"), store, "work", "none", lambda d: d.withColumn("answer", F.lit(1)).drop("_asked"))
    assert empty.collect() == [] and "answer" in empty.columns


def test_all_vectors_of_a_question_id_count(spark):
    vectors = lambda rows: spark.createDataFrame(rows, "{} string, embedding array<double>".format("question_id" if rows[0][0][0] == "q" else "id"))
    docs = vectors([("d1", [1.0, 0.0]), ("d2", [0.0, 1.0]), ("d3", [1.0, 1.0]), ("d4", [-1.0, 0.0])])
    questions = vectors([("q1", [1.0, 0.0]), ("q1", [0.0, 1.0]), ("q2", [-1.0, 0.0])])
    for block in (1, 2, 10):
        hits = cosine_topk(questions, docs, 3, block=block).collect()
        got = {(h.question_id, h.place): (h.id, round(h.similarity, 3)) for h in hits}
        assert got[("q1", 1)] == ("d1", 1.0) and got[("q1", 2)] == ("d2", 1.0) and got[("q1", 3)] == ("d3", 0.707)
        assert got[("q2", 1)] == ("d4", 1.0) and len(hits) == 6
