from datetime import datetime, timedelta

import pytest

from trendloom.plans import metrics, serving

LAST = datetime(2024, 1, 15, 12)
TRENDING = (
    "hour_window timestamp, tag string, mention_count bigint, source_diversity bigint, trend_score double, "
    "rank_in_hour int, positive_count bigint, negative_count bigint, neutral_count bigint, gold_computed_at timestamp"
)
MOMENTUM = (
    "day_window timestamp, language string, mention_count bigint, total_stars bigint, momentum_score double, "
    "source_diversity bigint, rank_by_day int"
)
CONTENT = "global_rank int, source string, language string, title string, url string, popularity_score int, tags array<string>"
ACTIVITY = "hour_window timestamp, source string, activity_score double"


def ago(hours):
    return LAST - timedelta(hours=hours)


@pytest.fixture
def trending(spark):
    rows = [
        (LAST, "b", 5, 2, 20.125, 2, 1, 0, 4, LAST), (LAST, "a", 9, 3, 30.0, 1, 9, 0, 0, LAST),
        (LAST, "c", 1, 1, 20.125, 2, 0, 1, 0, LAST), (ago(3), "a", 2, 2, 50.0, 1, 0, 2, 0, LAST),
        (ago(200), "d", 9, 3, 99.0, 1, 9, 0, 0, LAST),
    ]
    return spark.createDataFrame(rows, TRENDING)


def tags(df):
    return [r.tag for r in df.collect()]


def test_views_round_half_to_even(spark, trending):
    view = serving.trending_view(trending).collect()
    assert [(r.tag, r.trend_score) for r in view[:3]] == [("a", 30.0), ("b", 20.12), ("c", 20.12)]
    momentum = spark.createDataFrame([(LAST, "go", 1, 1, 2.5, 1, 1), (LAST, "x", 1, None, None, 1, 2)], MOMENTUM)
    assert [r.momentum_score for r in serving.momentum_view(momentum).collect()] == [2, None]
    activity = spark.createDataFrame([(LAST, "s", 0.25)], ACTIVITY)
    assert serving.activity_view(activity).first().activity_score == 0.2


def test_recent_activity(spark):
    activity = spark.createDataFrame([(ago(h), "s", 1.0) for h in range(50)], ACTIVITY)
    assert serving.recent_activity(activity).count() == 25
    assert serving.recent_activity(activity, newest_rows=3).count() == 3


def test_latest_hour(trending):
    assert tags(serving.top_now(trending, 2)) == ["a", "b"]
    assert tags(serving.top_topics(serving.filter_topics(trending), 2)) == ["a", "b"]


def test_topic_filter(trending):
    assert sorted(tags(serving.filter_topics(trending))) == ["a", "a", "b", "c"]
    assert sorted(tags(serving.filter_topics(trending, 1))) == ["a", "b", "c"]
    assert sorted(tags(serving.filter_topics(trending, 168, min_sources=2, min_mentions=5))) == ["a", "b"]


def test_topic_reports(trending):
    kept = serving.filter_topics(trending)
    assert tags(serving.topic_series(kept, ["a"])) == ["a", "a"]
    assert sorted(set(tags(serving.topic_series(kept)))) == ["a", "b", "c"]
    assert tags(serving.cross_source_topics(kept, n=2)) == ["a", "a"]
    sums = [(r.tag, r.positive, r.negative, r.neutral) for r in serving.topic_sentiment(kept, 2).collect()]
    assert sums == [("a", 9, 2, 0), ("b", 1, 0, 4)]


def test_languages(spark):
    rows = [
        (LAST, "go", 1, 50, 9.0, 1, 2), (LAST, "rust", 2, 50, 8.0, 1, 3), (LAST, "sql", 3, 90, 99.0, 2, 1),
        (LAST, "go", 1, 10, 9.0, 1, 2), (ago(24 * 8), "old", 1, 999, 1.0, 1, 1), (ago(24), "c", 1, 1, 1.0, 1, 1),
    ]
    kept = serving.filter_languages(spark.createDataFrame(rows, MOMENTUM))
    assert [(r.language, r.total_stars) for r in serving.language_leaders(kept, 2).collect()] == [("sql", 90), ("go", 50)]
    assert {r.language for r in serving.language_series(kept).collect()} == {"c", "go", "rust", "sql"}
    assert {r.language for r in serving.language_series(kept, ["c"]).collect()} == {"c"}
    assert serving.stars_and_mentions(kept).count() == 4


def test_content(spark):
    rows = [(i, "github" if i % 2 else "newsapi", "Go" if i % 3 else None, f"t{i // 2}", "u", i, ["a", "b", "c", "d"]) for i in range(1, 21)]
    content = spark.createDataFrame(rows, CONTENT)
    assert [r.global_rank for r in serving.filter_content(content, n=3).collect()] == [1, 2, 3]
    assert [r.global_rank for r in serving.filter_content(content, "github", "Go", 2).collect()] == [1, 5]
    assert [r.global_rank for r in serving.unique_titles(serving.filter_content(content, n=5)).collect()] == [1, 2, 4]
    assert serving.content_view(content).first().tags_str == "a, b, c"
    assert {r.source: r["count"] for r in serving.items_by_source(content).collect()} == {"github": 10, "newsapi": 10}
    box = {r.source: r for r in serving.popularity_distribution(content).collect()}["github"]
    assert (box.minimum, box.lower_quartile, box.median, box.upper_quartile, box.maximum) == (1, 5.5, 10, 14.5, 19)


def test_summary_and_counts(spark, trending):
    content = spark.createDataFrame([(1, "s", None, "t", "u", 1, [])], CONTENT)
    activity = spark.createDataFrame([(LAST, "s", 1.0), (LAST, "r", 1.0)], ACTIVITY)
    row = serving.run_summary(trending, content, activity, None).first()
    assert (row.total_topics, row.total_content, row.total_enriched, row.sources_active) == (4, 1, 0, 2)
    empty = serving.run_summary(trending.limit(0), content.limit(0), activity.limit(0), content).first()
    assert (empty.total_topics, empty.total_content, empty.total_enriched, empty.latest_update) == (0, 0, 1, None)
    counts = metrics.layer_counts(spark, {"a": content, "b": None}).collect()
    assert {r.table: r.rows for r in counts} == {"a": 1, "b": 0}
