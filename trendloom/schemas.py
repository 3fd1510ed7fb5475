"""Declared schemas of the Bronze, Silver and enrichment layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Feed names, topics and field lists are part of the stored data format.
HACKERNEWS = "hackernews"
NEWSAPI = "newsapi"
GITHUB = "github"
PIPELINE_VERSION = "1.0.0"

_TEXT, _INT, _LONG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()
_TEXTS = T.ArrayType(_TEXT)


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


HN_SCHEMA = _fields(
    id=_LONG, type=_TEXT, by=_TEXT, title=_TEXT, url=_TEXT, score=_INT, descendants=_INT,
    time=_LONG, text=_TEXT, ingested_at=_TEXT, source=_TEXT, pipeline_version=_TEXT,
)
NEWS_SCHEMA = _fields(
    article_id=_TEXT, title=_TEXT, description=_TEXT, url=_TEXT, published_at=_TEXT,
    author=_TEXT, source_name=_TEXT, query_tag=_TEXT, ingested_at=_TEXT, source=_TEXT,
    pipeline_version=_TEXT,
)
GITHUB_SCHEMA = _fields(
    repo_id=_LONG, repo_name=_TEXT, repo_url=_TEXT, description=_TEXT, stars=_INT, forks=_INT,
    language=_TEXT, topics=_TEXTS, created_at=_TEXT, updated_at=_TEXT, owner=_TEXT,
    language_filter=_TEXT, ingested_at=_TEXT, source=_TEXT, pipeline_version=_TEXT,
)

BRONZE_SUFFIX = _fields(
    kafka_timestamp=_TIME, bronze_ingested_at=_TIME, kafka_topic=_TEXT,
)

# Partition column of a Bronze table that is split by day of arrival.
INGEST_DAY = "ingest_day"

SILVER_SCHEMA = _fields(
    unified_id=_TEXT, source=_TEXT, title=_TEXT, description=_TEXT, url=_TEXT, author=_TEXT,
    popularity_score=_INT, tags=_TEXTS, language=_TEXT, published_at=_TIME, ingested_at=_TIME,
    silver_processed_at=_TIME, pipeline_version=_TEXT,
)

# What a model response must hold, and the columns it becomes.
AI_RESULT_SCHEMA = _fields(
    sentiment=_TEXT, ai_topics=_TEXTS, entities=_TEXTS,
)
ENRICHMENT_SCHEMA = _fields(
    sentiment=_TEXT, ai_topics=_TEXTS, ai_entities=_TEXTS, enrichment_error=_TEXT,
    enriched_at=_TIME, llm_model=_TEXT,
)
ENRICHED_SCHEMA = T.StructType(SILVER_SCHEMA.fields + ENRICHMENT_SCHEMA.fields)

# The columns a message stream delivers.
MESSAGE_SCHEMA = _fields(
    key=T.BinaryType(), value=T.BinaryType(), topic=_TEXT, partition=_INT, offset=_LONG,
    timestamp=_TIME,
)


@dataclass(frozen=True)
class Feed:
    """One content feed: where its messages come from and what a usable message holds."""

    name: str
    source: str
    topic: str
    schema: T.StructType
    required: tuple[str, ...]


FEEDS = {
    feed.name: feed
    for feed in (
        Feed("hn", HACKERNEWS, "hn-raw", HN_SCHEMA, ("title",)),
        Feed("news", NEWSAPI, "news-raw", NEWS_SCHEMA, ("title", "article_id")),
        Feed("github", GITHUB, "github-raw", GITHUB_SCHEMA, ("repo_id",)),
    )
}
