import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.plans import enrich, jobs, metrics
from trendloom.schemas import ENRICHED_SCHEMA, SILVER_SCHEMA
from trendloom.sources.tables import TableStore

TEXT = "unified_id string, source string, title string, description string, popularity_score int"


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, TEXT)


def fake_enricher():
    def answer(text):
        if "fail" in text:
            raise RuntimeError("x" * 150)
        if "fence" in text:
            return '```json\n{"sentiment": "positive", "ai_topics": ["1","2","3","4","5"], "entities": ["E"]}\n```'
        if "bare" in text:
            return "```\n{}```"
        if "broken" in text:
            return "not json"
        return json.dumps({"sentiment": "negative", "ai_topics": [str(len(text))], "entities": "none"})

    return answer


def test_answers_and_failures(spark):
    given = rows_of(
        spark, ("1", "s", "fence", None, 1), ("2", "s", "broken", "d", 1), ("3", "s", "fail", "d", 1),
        ("4", "s", "  ", "d", 1), ("5", "s", None, "d", 1), ("6", "s", "ok", "y" * 2000, 1), ("7", "s", "bare", "", 1),
    )
    got = {r.unified_id: r for r in enrich.enrich(given, fake_enricher, "fake", parallel_calls=3).collect()}

    def parts(i):
        return got[i].sentiment, got[i].ai_topics, got[i].ai_entities, got[i].enrichment_error

    assert parts("1") == ("positive", ["1", "2", "3", "4"], ["E"], None)
    assert parts("2") == ("neutral", [], [], "json_parse_error")
    assert parts("3") == ("neutral", [], [], "x" * 100)
    assert parts("4") == parts("5") == ("neutral", [], [], "empty_title")
    assert parts("6") == ("negative", ["2004"], ["none"], None)
    assert parts("7") == ("neutral", [], [], None)
    assert got["1"].llm_model == "fake" and got["1"].enriched_at is not None


def test_budget_and_template(spark):
    given = rows_of(spark, ("6", "s", "ok", "y" * 2000, 1))
    assert enrich.enrich(given, fake_enricher, max_chars=800).first().ai_topics == ["800"]
    assert enrich.enrich(given, fake_enricher, template="JSON for: %s!").first().ai_topics == ["2015"]
    long = rows_of(spark, ("7", "s", "ok", "z" * 500_000, 1))
    assert enrich.enrich(long, fake_enricher).first().ai_topics == ["500004"]


@pytest.mark.parametrize(("raw", "topics", "error"), [
    ("[1,2]", [], "json_parse_error"), ('"hello"', [], "json_parse_error"), ("3", [], "json_parse_error"), ("null", [], "json_parse_error"),
    ("", [], "json_parse_error"), ('{"a": 1} tail', [], "json_parse_error"), ('{"entities": null}', [], "null_list"), ('{"ai_topics": null}', [], "null_list"),
    ('{"ai_topics": "rust"}', ["rust"], None), ('{"ai_topics": ["a"], "ai_topics": ["b", "c"]}', ["b", "c"], None), ("{}", [], None),
    ('{"ai_topics": null, "ai_topics": ["x"]}', ["x"], None), ('{"ai_topics": ["1", "2", "3", "4", "5"]}', ["1", "2", "3", "4"], None),
])
def test_answers_that_are_not_what_was_asked(spark, raw, topics, error):
    asked = spark.createDataFrame([(raw, None)], "raw string, failure string")
    got = enrich.parse_responses(asked, "raw", "failure", F.lit(False)).first()
    assert (got.ai_topics, got.enrichment_error) == (topics, error)
    if len(topics) == 4:
        assert len(enrich.parse_responses(asked, "raw", "failure", F.lit(False), None).first().ai_topics) == 5


def test_default_runs_without_python(spark):
    plan = enrich.enrich(rows_of(spark, ("1", "s", "t", "d", 1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_lexicon_default(spark):
    given = rows_of(spark, ("1", "s", "Great new Python release", None, 1), ("2", "s", "Crash and data breach", "", 1))
    got = {r.unified_id: r for r in enrich.enrich(given).collect()}
    assert got["1"].sentiment == "positive" and got["1"].ai_topics == ["python"]
    assert got["2"].sentiment == "negative" and got["2"].ai_topics == ["data"]


def test_candidates(spark):
    table = rows_of(
        spark, ("a", "s", "t", None, 5), ("b", "s", "t", None, 9), ("c", "s", "t", None, 5), ("d", "s", " ", None, 99),
        ("e", "s", "t", None, None), ("f", "s", "t", None, 7),
    )
    done = spark.createDataFrame([("b", None), ("f", "timeout")], "unified_id string, enrichment_error string")

    def ids(*args, **kwargs):
        return sorted(r.unified_id for r in enrich.enrichment_candidates([table, table.limit(0)], *args, **kwargs).collect())

    assert ids(None, 2) == ["b", "f"]
    assert ids(done, 2) == ["a", "c"]
    assert ids(done, 2, retry_errors=True) == ["a", "f"]
    assert ids(done, 50) == ["a", "c", "e"]


def silver_row(uid, title, popularity):
    row = dict(unified_id=uid, source="hackernews", title=title, popularity_score=popularity, tags=["hackernews"],
               published_at=datetime(2024, 1, 15), silver_processed_at=datetime(2024, 1, 15))
    return tuple(row.get(n) for n in SILVER_SCHEMA.names)


def test_runs_continue_where_the_last_one_ended(spark, folder):
    store = TableStore(spark, folder, "parquet")
    store.upsert(spark.createDataFrame([silver_row(f"u{i}", "fence" if i else "broken", i) for i in range(5)], SILVER_SCHEMA),
                 "silver", "hn", "unified_id")
    assert jobs.run_enrichment(store, fake_enricher, "fake", size=3) == 3
    assert jobs.run_enrichment(store, fake_enricher, "fake", size=3) == 2
    assert jobs.run_enrichment(store, fake_enricher, "fake", size=3) == 0
    stored = store.read("silver", "enriched")
    assert set(stored.columns) == set(ENRICHED_SCHEMA.names)
    assert stored.select("unified_id").distinct().count() == stored.count() == 5
    assert metrics.enrichment_errors(stored).first().asDict() == {"total": 5, "errors": 1, "error_pct": 20.0}
    assert {(r.sentiment, r["count"]) for r in metrics.sentiment_distribution(stored).collect()} == {("positive", 4), ("neutral", 1)}
    assert jobs.load_combined(store).filter(F.col("sentiment") == "positive").count() == 4


def test_error_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "enrichment_error string")
    assert metrics.enrichment_errors(empty).first().asDict() == {"total": 0, "errors": 0, "error_pct": None}
