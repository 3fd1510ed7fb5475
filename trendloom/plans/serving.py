"""Queries a dashboard asks of the Gold tables. Every function maps Gold frames to one frame.

Gold tables are aggregates. "Latest" values come from scalar subqueries, and every cut has a
complete order, so equal scores give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.numbers import round_scaled
from trendloom.operators.latest import first_per_group

# Default sizes of the views.
WINDOW_HOURS = 24
TOP_NOW = 5
HOURS_BACK = 168
TOP_TOPICS = 15
CROSS_SOURCE_TOPICS = 20
SENTIMENT_TOPICS = 15
SERIES_TOPICS = 5
SERIES_LANGUAGES = 6
DAYS_BACK = 7
LANGUAGE_LEADERS = 9
TOP_ITEMS = 50


def _latest(df: DataFrame, column: str) -> Column:
    return df.agg(F.max(column)).scalar()


def _hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


# ---- views over one table ---------------------------------------------------------------


def trending_view(trending: DataFrame) -> DataFrame:
    return trending.withColumn("trend_score", round_scaled("trend_score", 2)).orderBy(
        F.col("hour_window").desc(), "rank_in_hour", "tag"
    )


def momentum_view(momentum: DataFrame) -> DataFrame:
    """Scores as whole numbers; a null score stays null."""
    return momentum.withColumn(
        "momentum_score", F.rint("momentum_score").cast("bigint")
    ).orderBy(F.col("day_window").desc(), "rank_by_day", "language")


def activity_view(activity: DataFrame) -> DataFrame:
    return activity.withColumn("activity_score", round_scaled("activity_score", 1)).orderBy(
        F.col("hour_window").desc(), "source"
    )


def content_view(content: DataFrame) -> DataFrame:
    return content.withColumn("tags_str", F.array_join(F.slice("tags", 1, 3), ", ")).orderBy(
        "global_rank", "source", "title"
    )


def run_summary(
    trending: DataFrame, content: DataFrame, activity: DataFrame, enriched: DataFrame | None
) -> DataFrame:
    """One row: distinct topics, content rows, enriched rows, active sources, last computation."""

    def rows(df: DataFrame | None) -> Column:
        return F.lit(0).cast("bigint") if df is None else df.agg(F.count(F.lit(1))).scalar()

    return trending.agg(
        F.countDistinct("tag").alias("total_topics"),
        F.max("gold_computed_at").alias("latest_update"),
    ).select(
        "total_topics",
        rows(content).alias("total_content"),
        rows(enriched).alias("total_enriched"),
        activity.agg(F.countDistinct("source")).scalar().alias("sources_active"),
        "latest_update",
    )


# ---- home -------------------------------------------------------------------------------


def recent_activity(
    activity: DataFrame, hours: int = WINDOW_HOURS, newest_rows: int | None = None
) -> DataFrame:
    """Activity of the last ``hours`` before the newest hour; optionally only the newest rows."""
    view = activity_view(activity)
    recent = view.filter(F.col("hour_window") >= _hours_before(_latest(activity, "hour_window"), hours))
    return recent if newest_rows is None else recent.limit(newest_rows)


def top_now(trending: DataFrame, n: int = TOP_NOW) -> DataFrame:
    latest = trending.filter(F.col("hour_window") == _latest(trending, "hour_window"))
    return latest.orderBy("rank_in_hour", "tag").limit(n)


# ---- topics -----------------------------------------------------------------------------


def filter_topics(
    trending: DataFrame, hours_back: int = HOURS_BACK, min_sources: int = 1, min_mentions: int = 1
) -> DataFrame:
    start = _hours_before(_latest(trending, "hour_window"), hours_back)
    return trending.filter(
        (F.col("hour_window") >= start)
        & (F.col("source_diversity") >= min_sources)
        & (F.col("mention_count") >= min_mentions)
    )


def top_topics(filtered: DataFrame, n: int = TOP_TOPICS) -> DataFrame:
    """Best topics of the newest hour that passed the filter."""
    latest = filtered.filter(F.col("hour_window") == _latest(filtered, "hour_window"))
    return latest.orderBy(F.col("trend_score").desc_nulls_last(), "tag").limit(n)


def _selected(df: DataFrame, column: str, chosen: Sequence[str] | None, default: int) -> DataFrame:
    """Rows of the chosen values, or of the first ``default`` values in alphabetical order."""
    if chosen is not None:
        return df.filter(F.col(column).isin(list(chosen)))
    first = df.select(column).distinct().orderBy(column).limit(default)
    return df.join(F.broadcast(first), column, "left_semi")


def topic_series(filtered: DataFrame, tags: Sequence[str] | None = None) -> DataFrame:
    return _selected(filtered, "tag", tags, SERIES_TOPICS).orderBy("tag", "hour_window")


def cross_source_topics(
    filtered: DataFrame, min_sources: int = 2, n: int = CROSS_SOURCE_TOPICS
) -> DataFrame:
    shared = filtered.filter(F.col("source_diversity") >= min_sources)
    return shared.orderBy(
        F.col("trend_score").desc_nulls_last(), F.col("hour_window").desc(), "tag"
    ).limit(n)


def topic_sentiment(filtered: DataFrame, n: int = SENTIMENT_TOPICS) -> DataFrame:
    sums = [
        F.sum(f"{label}_count").alias(label) for label in ("positive", "negative", "neutral")
    ]
    return filtered.groupBy("tag").agg(*sums).orderBy(F.col("positive").desc(), "tag").limit(n)


# ---- languages --------------------------------------------------------------------------


def filter_languages(momentum: DataFrame, days_back: int = DAYS_BACK) -> DataFrame:
    start = _hours_before(_latest(momentum, "day_window"), 24 * days_back)
    return momentum.filter(F.col("day_window") >= start)


def latest_languages(filtered: DataFrame) -> DataFrame:
    return filtered.filter(F.col("day_window") == _latest(filtered, "day_window"))


def language_leaders(filtered: DataFrame, n: int = LANGUAGE_LEADERS) -> DataFrame:
    """Newest day by stars, one row per language."""
    order = [F.col("total_stars").desc_nulls_last(), F.col("rank_by_day")]
    single = first_per_group(latest_languages(filtered), ["language"], order)
    return single.orderBy(F.col("total_stars").desc_nulls_last(), "language").limit(n)


def language_series(filtered: DataFrame, languages: Sequence[str] | None = None) -> DataFrame:
    return _selected(filtered, "language", languages, SERIES_LANGUAGES).orderBy(
        "language", "day_window"
    )


def stars_and_mentions(filtered: DataFrame) -> DataFrame:
    return latest_languages(filtered).select(
        "language", "mention_count", "total_stars", "momentum_score", "source_diversity"
    )


# ---- content ----------------------------------------------------------------------------


def filter_content(
    content: DataFrame, source: str | None = None, language: str | None = None, n: int = TOP_ITEMS
) -> DataFrame:
    kept = content
    if source is not None:
        kept = kept.filter(F.col("source") == source)
    if language is not None:
        kept = kept.filter(F.col("language") == language)
    return kept.orderBy("global_rank", "source", "title", "url").limit(n)


def popularity_distribution(content: DataFrame) -> DataFrame:
    """Minimum, quartiles and maximum of popularity per source."""
    marks = ("minimum", "lower_quartile", "median", "upper_quartile", "maximum")
    points = F.percentile("popularity_score", F.array(*[F.lit(i / 4) for i in range(5)]))
    box = content.groupBy("source").agg(points.alias("_p"))
    return box.select("source", *[F.col("_p")[i].alias(name) for i, name in enumerate(marks)])


def items_by_source(content: DataFrame) -> DataFrame:
    return content.groupBy("source").agg(F.count(F.lit(1)).alias("count"))


def unique_titles(filtered: DataFrame) -> DataFrame:
    """The best ranked row of every title within the filtered leaderboard."""
    order = [F.col(c) for c in ("global_rank", "source", "url")]
    return first_per_group(filtered, ["title"], order).orderBy("global_rank", "source", "title")
