from datetime import datetime

from trendloom.functions.text import clean_text, has_text
from trendloom.plans.silver import drop_empty_titles, github_to_silver, hn_to_silver, news_to_silver
from trendloom.schemas import GITHUB_SCHEMA, HN_SCHEMA, NEWS_SCHEMA, SILVER_SCHEMA

AT = datetime(2024, 2, 1)
STAMP = "2024-01-15T10:00:00+00:00"


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def hn(**fields):
    base = dict(id=1, type="story", by=" ann ", title=" A  b ", url="https://x.com", score=5,
                time=1705312800, text="  ", ingested_at=STAMP, source="hackernews", pipeline_version="1.0.0")
    return {**base, **fields}


def test_drop_empty_titles(spark):
    df = spark.createDataFrame([("Kept",), (None,), ("   ",)], "title string")
    assert [r.title for r in drop_empty_titles(df).collect()] == ["Kept"]


def test_hn_row(spark):
    rows = hn_to_silver(frame(spark, HN_SCHEMA, hn()), AT)
    assert rows.schema.names == SILVER_SCHEMA.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in SILVER_SCHEMA]
    row = rows.selectExpr("*", "cast(published_at as string) at", "cast(silver_processed_at as string) done").first()
    assert (row.title, row.description, row.author) == ("A b", None, "ann")
    assert row.tags == ["hackernews", "story"] and row.language is None and row.popularity_score == 5
    assert row.at == "2024-01-15 10:00:00" and row.done == "2024-02-01 00:00:00"


def test_hn_keeps_newest_titled_identified_rows(spark):
    given = frame(
        spark, HN_SCHEMA, hn(), hn(score=9, ingested_at="2024-01-15T11:00:00+00:00"),
        hn(score=7, ingested_at=""), hn(id=2, title="  "), hn(id=3, title=None), hn(id=None),
    )
    assert [r.popularity_score for r in hn_to_silver(given).collect()] == [9]


def test_tied_versions_leave_one(spark):
    given = frame(spark, HN_SCHEMA, hn(score=1), hn(score=2), hn(score=None))
    assert hn_to_silver(given).count() == 1


def test_news_row(spark):
    base = dict(article_id="a1", title="T", description="d\n d", url="https://removed.com/1", author="",
                published_at="2024-01-15T10:23:00Z", source_name="Wire", query_tag="", ingested_at=STAMP,
                source="newsapi", pipeline_version="1.0.0")
    given = frame(spark, NEWS_SCHEMA, base, {**base, "article_id": "a2", "source_name": None, "query_tag": "ai"})
    rows = {tuple(r.tags): r for r in news_to_silver(given).collect()}
    assert set(rows) == {("newsapi", "Wire"), ("newsapi", "ai")}
    row = rows[("newsapi", "Wire")]
    assert (row.description, row.url, row.author, row.popularity_score) == ("d d", None, None, 0)


def test_github_row(spark):
    base = dict(repo_id=7, repo_name="o/r", repo_url="git://any", stars=12, language=" ", owner="o",
                topics=["a", "github", "a"], created_at="2024-01-15T10:23:00Z", ingested_at=STAMP,
                source="github", pipeline_version="1.0.0")
    given = frame(spark, GITHUB_SCHEMA, base, {**base, "repo_id": 8, "topics": None, "created_at": ""})
    first, second = sorted(github_to_silver(given).collect(), key=lambda r: len(r.tags), reverse=True)
    assert first.tags == ["github", "a"] and second.tags == ["github"]
    assert first.url == "git://any" and first.language is None and second.published_at is None


def test_rows_are_chosen_before_they_are_cleaned(spark):
    plan = hn_to_silver(frame(spark, HN_SCHEMA, hn()))._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.split("\n") if "Filter" in line]
    assert tests and not any("regexp_replace" in line or "md5" in line for line in tests)


def test_text_is_told_from_blank_as_cleaning_does(spark):
    given = ["A", " A ", "", " ", "\t\n\x0b\f\r ", "\n x", "\xa0", "\x1f", "\u2003", None]
    rows = spark.createDataFrame([(t,) for t in given], "t string").select("t", has_text("t").alias("got"), clean_text("t").alias("kept"))
    assert [r.got for r in rows.collect()] == [None if r.t is None else r.kept is not None for r in rows.collect()]
    stories = frame(spark, HN_SCHEMA, *[hn(id=n, title=t) for n, t in enumerate(given)], hn(id=None))
    assert hn_to_silver(stories).count() == 6
