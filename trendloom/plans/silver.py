"""Bronze to Silver: one unified row per item of each feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import clean_text, clean_url, has_text, not_blank, parse_timestamp, unified_id
from trendloom.operators.latest import newest_per_key
from trendloom.schemas import GITHUB, HACKERNEWS, NEWSAPI, SILVER_SCHEMA


def processing_time(as_of: datetime | None) -> Column:
    """The clock, or the given moment for repeatable runs."""
    return F.current_timestamp() if as_of is None else moment(as_of)


def moment(at: datetime) -> Column:
    """A timestamp literal read in the session's time zone (UTC)."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def drop_empty_titles(df: DataFrame) -> DataFrame:
    return df.filter(not_blank("title"))


def _hn_columns() -> dict[str, Column]:
    return {
        "unified_id": unified_id(HACKERNEWS, "id"),
        "title": clean_text("title"),
        "description": clean_text("text"),
        "url": clean_url("url"),
        "author": clean_text("by"),
        "popularity_score": F.col("score"),
        "tags": F.array(F.lit(HACKERNEWS), F.col("type")),
        "language": F.lit(None),
        "published_at": parse_timestamp("time"),
    }


def _news_columns() -> dict[str, Column]:
    labels = F.array(F.lit(NEWSAPI), F.col("source_name"), F.col("query_tag"))
    return {
        "unified_id": unified_id(NEWSAPI, "article_id"),
        "title": clean_text("title"),
        "description": clean_text("description"),
        "url": clean_url("url"),
        "author": clean_text("author"),
        "popularity_score": F.lit(0),
        "tags": F.array_compact(F.array_remove(labels, "")),
        "language": F.lit(None),
        "published_at": parse_timestamp("published_at"),
    }


def _github_columns() -> dict[str, Column]:
    topics = F.coalesce(F.col("topics"), F.array().cast("array<string>"))
    return {
        "unified_id": unified_id(GITHUB, "repo_id"),
        "title": clean_text("repo_name"),
        "description": clean_text("description"),
        "url": F.col("repo_url"),
        "author": clean_text("owner"),
        "popularity_score": F.col("stars"),
        "tags": F.array_union(F.array(F.lit(GITHUB)), topics),
        "language": clean_text("language"),
        "published_at": parse_timestamp("created_at"),
    }


_MAPPINGS = {"hn": _hn_columns, "news": _news_columns, "github": _github_columns}

# The Bronze columns that become the id and the title.
_ID_AND_TITLE = {"hn": ("id", "title"), "news": ("article_id", "title"), "github": ("repo_id", "repo_name")}


def map_feed(bronze: DataFrame, feed: str, as_of: datetime | None = None) -> DataFrame:
    """Project one feed's Bronze columns onto the Silver schema, row for row."""
    columns = {
        **_MAPPINGS[feed](),
        "source": F.col("source"),
        "ingested_at": parse_timestamp("ingested_at"),
        "silver_processed_at": processing_time(as_of),
        "pipeline_version": F.col("pipeline_version"),
    }
    return bronze.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in SILVER_SCHEMA.fields]
    )


def to_silver(bronze: DataFrame, feed: str, as_of: datetime | None = None) -> DataFrame:
    """Cleaned, titled and de-duplicated rows of one feed, ready for a keyed upsert.

    Rows without an id are left out: they can never match and would be inserted again each run. Both
    tests are made on the Bronze columns: on the Silver ones the filter would clean and hash each row
    for itself, before the projection does it again.
    """
    original_id, title = _ID_AND_TITLE[feed]
    usable = bronze.filter(F.col(original_id).isNotNull() & has_text(title))
    return newest_per_key(map_feed(usable, feed, as_of), "unified_id")


def hn_to_silver(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return to_silver(bronze, "hn", as_of)


def news_to_silver(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return to_silver(bronze, "news", as_of)


def github_to_silver(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return to_silver(bronze, "github", as_of)
