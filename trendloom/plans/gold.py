"""Silver to Gold: trending topics, language momentum, source activity, top content."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import sentiment as S
from trendloom.functions.text import not_blank
from trendloom.operators.latest import newest_per_key, top_per_group
from trendloom.operators.ranking import leaders, rank_by_score
from trendloom.operators.settle import settle
from trendloom.plans.silver import moment, processing_time
from trendloom.schemas import ENRICHMENT_SCHEMA, GITHUB, HACKERNEWS

# Tags that name a feed or a fetch slice instead of a topic.
GENERIC_TAGS = ("hackernews", "newsapi", "github", "story", "top_headlines")

# Tags counted as mentions of a programming language.
LANGUAGE_TAGS = (
    "python", "javascript", "typescript", "rust", "go", "java", "kotlin",
    "swift", "sql", "c++", "c#", "ruby", "scala", "r",
)

# Table sizes of the leaderboard.
LEADERBOARD_DAYS = 7
LEADERBOARD_PER_SOURCE = 50
SAMPLE_TITLES = 3

# Factors of the scores.
TREND_MENTION, TREND_POPULARITY, TREND_SOURCE = 1.0, 0.5, 10.0
MOMENTUM_MENTION = 5.0
ACTIVITY_SENTIMENT = 0.1
STARS_PER_POINT, SECONDS_PER_POINT = 10.0, 1e9

# Columns that only the leaderboard shows; they are looked up for its rows.
LOOKED_UP = ("description", "url", "author")

# Columns of the combined rows that no Gold table is made from.
UNREAD = ("ingested_at", "silver_processed_at", "pipeline_version", "enrichment_error")

_ENRICHMENT = ("sentiment", "ai_topics", "ai_entities", "enrichment_error")


# ---- input ------------------------------------------------------------------------------


def attach_enrichment(silver: DataFrame, enriched: DataFrame | None) -> DataFrame:
    """Add sentiment, topics and entities by id; rows without enrichment get nulls.

    The newest enrichment of an id is used, so an id enriched twice does not fan out. Both
    sides are partitioned by ``unified_id``, which the join reuses.
    """
    types = {f.name: f.dataType for f in ENRICHMENT_SCHEMA.fields}
    if enriched is None:
        return silver.withColumns({c: F.lit(None).cast(types[c]) for c in _ENRICHMENT})
    present = set(enriched.columns)
    signals = enriched.select(
        "unified_id",
        *[F.col(c) if c in present else F.lit(None).cast(types[c]).alias(c) for c in _ENRICHMENT],
        F.col("enriched_at") if "enriched_at" in present
        else F.lit(None).cast("timestamp").alias("enriched_at"),
    )
    newest = newest_per_key(signals, "unified_id", "enriched_at", list(_ENRICHMENT))
    return silver.join(newest.drop("enriched_at"), "unified_id", "left")


def combine_silver(
    tables: Iterable[DataFrame], enriched: DataFrame | None = None, unique: bool = False
) -> DataFrame:
    """All feeds by column name, newest processing per id, enrichment attached.

    A stored Silver table holds each id once, and an id names its feed. Ties are settled by the
    narrow columns, so builders that need no text read none. With ``unique`` the tables are known to
    hold each id once: nothing is sorted, and the columns of the order are read only where asked for.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if unique:
        return attach_enrichment(union, enriched)
    ties = ["ingested_at", "popularity_score", "source", "published_at", "language", "tags"]
    current = newest_per_key(union, "unified_id", "silver_processed_at", ties)
    return attach_enrichment(current, enriched)


def for_builders(combined: DataFrame) -> DataFrame:
    """What the builders read of every row, so that nothing else is joined, sorted and written."""
    return combined.drop(*LOOKED_UP, *UNREAD)


# ---- shared measures --------------------------------------------------------------------


def _popularity_measures() -> list[Column]:
    return [
        F.sum("popularity_score").alias("_popularity"),
        F.count("popularity_score").alias("_scored"),
    ]


def _total(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


# ---- trending topics --------------------------------------------------------------------


def topic_mentions(
    combined: DataFrame, topic_col: str = "tags", generic_tags: Iterable[str] = GENERIC_TAGS
) -> DataFrame:
    """One row per item and topic, with the item's hour."""
    return (
        combined.filter(F.col("published_at").isNotNull())
        .select(
            F.date_trunc("hour", "published_at").alias("hour_window"),
            F.explode(topic_col).alias("tag"),
            "source", "popularity_score", "sentiment", "title", "unified_id",
        )
        .filter((F.length("tag") > 1) & ~F.col("tag").isin(*generic_tags))
    )


def sample_titles(mentions: DataFrame, n: int = SAMPLE_TITLES) -> DataFrame:
    """The ``n`` most popular titles per hour and topic, cut to ``n`` before any shuffle."""
    order = [F.col("popularity_score").desc_nulls_last(), F.col("title"), F.col("unified_id")]
    titled = mentions.filter(F.col("title").isNotNull()).select(
        "hour_window", "tag", "title", "popularity_score", "unified_id"
    )
    best = top_per_group(titled, ["hour_window", "tag"], order, n, "_place")
    return (
        best.groupBy("hour_window", "tag")
        .agg(F.sort_array(F.collect_list(F.struct("_place", "title"))).alias("_titles"))
        .select("hour_window", "tag", F.col("_titles.title").alias("sample_titles"))
    )


def trending_topics(
    combined: DataFrame,
    as_of: datetime | None = None,
    topic_col: str = "tags",
    generic_tags: Iterable[str] = GENERIC_TAGS,
) -> DataFrame:
    """Topics by hour with a sentiment-weighted trend score and their rank in the hour.

    Mentions are counted per (hour, topic, source) first, so that the number of sources is a
    plain count afterwards and a hot topic is spread over its sources. Every label count takes
    part in the score, which lets the ranking read the same shuffle as the result.
    """
    mentions = topic_mentions(combined, topic_col, generic_tags)
    label = F.coalesce(F.col("sentiment"), F.lit(""))
    per_source = mentions.groupBy("hour_window", "tag", "source").agg(
        *_popularity_measures(),
        S.count_label(S.POSITIVE).alias("positive_count"),
        S.count_label(S.NEGATIVE).alias("negative_count"),
        S.count_label(S.NEUTRAL).alias("neutral_count"),
        F.count_if(~label.isin(S.POSITIVE, S.NEGATIVE, S.NEUTRAL)).alias("_unlabelled"),
    )
    labels = ("positive_count", "negative_count", "neutral_count", "_unlabelled")
    counted = (
        per_source.groupBy("hour_window", "tag")
        .agg(*_total("_popularity", "_scored", *labels), F.count("source").alias("source_diversity"))
        .withColumns({
            "mention_count": reduce(lambda a, b: a + b, [F.col(c) for c in labels]),
            "avg_popularity": F.try_divide("_popularity", "_scored"),
            "avg_sentiment_weight": S.TREND_WEIGHTS.average(
                "positive_count", "negative_count", F.col("neutral_count") + F.col("_unlabelled")
            ),
        })
    )
    volume = F.col("mention_count") * TREND_MENTION
    reach = F.col("avg_popularity") * TREND_POPULARITY + F.col("source_diversity") * TREND_SOURCE
    scored = counted.withColumn("trend_score", (volume + reach) * F.col("avg_sentiment_weight"))
    titled = scored.join(sample_titles(mentions), ["hour_window", "tag"], "left")
    return rank_by_score(titled, ["hour_window"], "trend_score", "rank_in_hour", scored).select(
        "hour_window", "tag", "mention_count", "avg_popularity", "source_diversity",
        "avg_sentiment_weight", "positive_count", "negative_count", "neutral_count",
        "trend_score", "rank_in_hour",
        F.coalesce("sample_titles", F.array().cast("array<string>")).alias("sample_titles"),
        processing_time(as_of).alias("gold_computed_at"),
    )


# ---- language momentum ------------------------------------------------------------------


def language_mentions(combined: DataFrame, normalise_case: bool = False) -> DataFrame:
    """One row per item and language it stands for: its own language field, and every tag that
    names a language. An item with both counts twice. One scan serves both.
    """
    own = F.lower("language") if normalise_case else F.col("language")
    none = F.array().cast("array<string>")
    declared = F.when(not_blank("language"), F.array(own)).otherwise(none)
    lowered = F.transform(F.coalesce(F.col("tags"), none), lambda tag: F.lower(tag))
    named = F.filter(lowered, lambda tag: tag.isin(*LANGUAGE_TAGS))
    tagged = F.when(F.col("published_at").isNotNull(), named).otherwise(none)
    return combined.select(
        F.date_trunc("day", "published_at").alias("day_window"),
        F.explode(F.concat(declared, tagged)).alias("language"),
        "source", "popularity_score", "sentiment",
    )


def language_momentum(
    combined: DataFrame, as_of: datetime | None = None, normalise_case: bool = False
) -> DataFrame:
    """Languages by day: stars and mentions, weighted by sentiment, ranked within the day.

    The rank runs over aggregated (day, language) rows; a day holds as many as there are
    programming languages.
    """
    per_source = language_mentions(combined, normalise_case).groupBy(
        "day_window", "language", "source"
    ).agg(
        F.count(F.lit(1)).alias("mention_count"),
        *_popularity_measures(),
        S.count_label(S.POSITIVE).alias("positive_mentions"),
        S.count_label(S.NEGATIVE).alias("negative_mentions"),
    )
    counted = per_source.groupBy("day_window", "language").agg(
        *_total("mention_count", "_popularity", "_scored", "positive_mentions", "negative_mentions"),
        F.count("source").alias("source_diversity"),
    )
    positive, negative = F.col("positive_mentions"), F.col("negative_mentions")
    scored = counted.withColumns({
        "total_stars": F.col("_popularity"),
        "avg_popularity": F.try_divide("_popularity", "_scored"),
        "avg_sentiment_weight": S.MOMENTUM_WEIGHTS.average(
            positive, negative, F.col("mention_count") - positive - negative
        ),
        "dominant_sentiment": F.when(positive > negative, S.POSITIVE)
        .when(negative > positive, S.NEGATIVE)
        .otherwise(S.NEUTRAL),
    }).withColumn(
        "momentum_score",
        (F.col("total_stars") + F.col("mention_count") * MOMENTUM_MENTION) * F.col("avg_sentiment_weight"),
    )
    day = Window.partitionBy("day_window").orderBy(F.col("momentum_score").desc_nulls_last())
    return scored.select(
        "day_window", "language", "mention_count", "total_stars", "avg_popularity",
        "source_diversity", "momentum_score", "avg_sentiment_weight", "dominant_sentiment",
        "positive_mentions", "negative_mentions",
        F.rank().over(day).alias("rank_by_day"),
        processing_time(as_of).alias("gold_computed_at"),
    ).orderBy("day_window", "rank_by_day")


# ---- source activity --------------------------------------------------------------------


def source_activity(combined: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Items, popularity and sentiment per source and hour: one partial aggregation, one shuffle."""
    counted = (
        combined.filter(F.col("published_at").isNotNull())
        .groupBy(F.date_trunc("hour", "published_at").alias("hour_window"), "source")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            *_popularity_measures(),
            F.max("popularity_score").alias("peak_popularity"),
            S.count_label(S.POSITIVE).alias("positive_items"),
            S.count_label(S.NEGATIVE).alias("negative_items"),
            S.count_label(S.NEUTRAL).alias("neutral_items"),
            F.count_if(F.col("sentiment").isNull()).alias("unenriched_items"),
        )
    )

    def share(items: str) -> Column:
        return F.round(F.col(items) / F.col("item_count") * 100, 1)

    positive, negative = F.col("positive_items"), F.col("negative_items")
    mood = S.ACTIVITY_WEIGHTS.average(positive, negative, F.col("item_count") - positive - negative)
    measured = counted.withColumns({
        "avg_popularity": F.try_divide("_popularity", "_scored"),
        "avg_sentiment_score": mood,
    })
    lift = F.lit(1.0) + F.col("avg_sentiment_score") * ACTIVITY_SENTIMENT
    return measured.select(
        "hour_window", "source", "item_count", "avg_popularity", "peak_popularity",
        F.col("_popularity").alias("total_popularity"),
        (F.col("item_count") * F.col("avg_popularity") * lift).alias("activity_score"),
        "avg_sentiment_score", "positive_items", "negative_items", "neutral_items",
        "unenriched_items",
        share("positive_items").alias("positive_rate_pct"),
        share("negative_items").alias("negative_rate_pct"),
        processing_time(as_of).alias("gold_computed_at"),
    ).orderBy("hour_window", F.col("item_count").desc())


# ---- top content ------------------------------------------------------------------------


def _period_start(as_of: datetime | None, days: int) -> Column:
    if as_of is None:
        return F.date_sub(F.current_date(), days).cast("timestamp")
    start = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=days)
    return moment(start)


def normalised_score() -> Column:
    """One scale over the feeds: stars are worth a tenth of a vote, news ranks by recency."""
    popularity = F.col("popularity_score").cast("double")
    return (
        F.when(F.col("source") == GITHUB, popularity / STARS_PER_POINT)
        .when(F.col("source") == HACKERNEWS, popularity)
        .otherwise(F.unix_timestamp("published_at").cast(T.DoubleType()) / SECONDS_PER_POINT)
    )


def top_content(
    combined: DataFrame,
    as_of: datetime | None = None,
    days: int = LEADERBOARD_DAYS,
    per_source: int = LEADERBOARD_PER_SOURCE,
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Leaderboard of the last ``days`` days: the best ``per_source`` ranks of each source with
    their rank over everything in the period. See :func:`trendloom.operators.ranking.leaders`.

    ``texts`` looks up ``unified_id`` and the columns :data:`LOOKED_UP` for the ids of the leaders, if
    ``combined`` is without these.
    """
    recent = (
        combined.filter(F.col("published_at") >= _period_start(as_of, days))
        .withColumns({
            "normalised_score": normalised_score(),
            "sentiment_boost": S.CONTENT_BOOST.of("sentiment"),
        })
        .withColumn("final_score", F.col("normalised_score") * F.col("sentiment_boost"))
    )
    ranked = leaders(recent, "source", "final_score", per_source, "source_rank", "global_rank")
    if texts is not None:
        ranked = settle(ranked)[0]
        ranked = ranked.join(texts(ranked.select("unified_id")), "unified_id", "left")
    return ranked.select(
        "global_rank", "source_rank", "source", "title", "description", "url", "author",
        "popularity_score", "normalised_score", "sentiment_boost", "final_score",
        "sentiment", "ai_topics", "ai_entities", "tags", "language", "published_at",
        processing_time(as_of).alias("gold_computed_at"),
    ).orderBy("global_rank")
