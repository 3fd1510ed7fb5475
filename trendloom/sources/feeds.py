"""Selecting and flattening feed payloads, as plans over tables or streams of raw payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import article_id
from trendloom.operators.latest import first_seen, top_per_group
from trendloom.plans.silver import moment
from trendloom.schemas import GITHUB, HACKERNEWS, NEWSAPI, PIPELINE_VERSION

# The slices the feeds are fetched in, and their sizes.
HN_FEEDS = ("top", "new")
HN_FEED_SIZE = 50
NEWS_QUERIES = (
    "artificial intelligence", "machine learning", "open source", "data engineering",
    "cloud computing",
)
NEWS_HEADLINES = "top"
NEWS_HEADLINE_SIZE = 100
NEWS_QUERY_SIZE = 20
REPO_LANGUAGES = ("python", "javascript", "typescript", "rust", "go", "java", "sql")
REPO_ALL = "all"
REPO_SLICE_SIZE = 30
REPO_DAYS = 7
REPO_MIN_STARS = 10


def with_ingest_metadata(df: DataFrame, source: str, at: datetime | None = None) -> DataFrame:
    """Keep all fields; add when, from where and by which version the row was taken in."""
    clock = F.current_timestamp() if at is None else moment(at)
    return df.withColumns({
        "ingested_at": F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ssxxx"),
        "source": F.lit(source),
        "pipeline_version": F.lit(PIPELINE_VERSION),
    })


def _slice_order(column: str, slices: Sequence[str]) -> Column:
    """Place of a slice in fetch order; unknown slices come last."""
    place = F.array_position(F.array(*[F.lit(s) for s in slices]), F.col(column))
    return F.when(place > 0, place).otherwise(F.lit(len(slices) + 1))


# ---- stories ----------------------------------------------------------------------------


def hn_stories(items: DataFrame) -> DataFrame:
    """Stories with a title; jobs, polls and comments are left out."""
    return items.filter((F.col("type") == "story") & (F.length("title") > 0))


def hn_feed_ids(
    members: DataFrame,
    order: Sequence[Column],
    size: int = HN_FEED_SIZE,
    feeds: Sequence[str] = HN_FEEDS,
) -> DataFrame:
    """Ids in the first ``size`` places of any of the feeds, once each: at most ``size`` per feed.

    ``members`` has ``feed``, ``id`` and whatever ``order`` sorts by.
    """
    read = members.filter(F.col("feed").isin(*feeds))
    return top_per_group(read, ["feed"], order, size).select("id").distinct()


def hn_messages(
    items: DataFrame,
    members: DataFrame,
    order: Sequence[Column],
    seen: DataFrame | None = None,
    at: datetime | None = None,
    size: int = HN_FEED_SIZE,
    feeds: Sequence[str] = HN_FEEDS,
) -> DataFrame:
    """The feeds' stories that were not sent before, with ingest metadata.

    The ids are few by construction, so the adaptive plan sends them to the tables of items and of
    known ids.
    """
    ids = hn_feed_ids(members, order, size, feeds)
    if seen is not None:
        known = seen.select("id").join(ids, "id", "left_semi")
        ids = ids.join(known, "id", "left_anti")
    chosen = items.join(ids, "id", "left_semi")
    return with_ingest_metadata(hn_stories(chosen), HACKERNEWS, at)


# ---- articles ---------------------------------------------------------------------------


def valid_articles(articles: DataFrame) -> DataFrame:
    """Articles with a title, not removed, with an address."""
    title = F.col("title")
    return articles.filter(
        (F.length(title) > 0) & ~title.contains("[Removed]") & (F.length("url") > 0)
    )


def flatten_articles(articles: DataFrame, at: datetime | None = None) -> DataFrame:
    """Nested article payloads to message columns; a missing text is ''. ``query`` names the slice."""

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    flat = articles.select(
        article_id("url").alias("article_id"),
        text("title").alias("title"),
        text("description").alias("description"),
        text("url").alias("url"),
        text("publishedAt").alias("published_at"),
        text("author").alias("author"),
        text("source.name").alias("source_name"),
        F.col("query").alias("query_tag"),
    )
    return with_ingest_metadata(flat, NEWSAPI, at)


def newest_articles(
    articles: DataFrame,
    query_size: int = NEWS_QUERY_SIZE,
    headline_size: int = NEWS_HEADLINE_SIZE,
) -> DataFrame:
    """The newest articles of every query, with a larger share for the headlines."""
    order = [F.col("publishedAt").desc_nulls_last(), F.col("url"), F.col("title")]
    headline = F.col("query") == NEWS_HEADLINES
    largest = max(query_size, headline_size)
    placed = top_per_group(articles, ["query"], order, largest, "_place")
    size = F.when(headline, headline_size).otherwise(query_size)
    return placed.filter(F.col("_place") <= size).drop("_place")


def news_messages(
    articles: DataFrame,
    slices: Sequence[str] = (NEWS_HEADLINES, *NEWS_QUERIES),
    seen: DataFrame | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Fetched articles to messages: each article once, headlines before queries."""
    usable = flatten_articles(valid_articles(newest_articles(articles)), at)
    order = [_slice_order("query_tag", slices), F.col("published_at").desc(), F.col("query_tag")]
    return first_seen(usable, "article_id", order, seen)


# ---- repositories -----------------------------------------------------------------------


def trending_repos(
    repos: DataFrame,
    as_of: datetime,
    languages: Sequence[str] = REPO_LANGUAGES,
    days: int = REPO_DAYS,
    min_stars: int = REPO_MIN_STARS,
    size: int = REPO_SLICE_SIZE,
) -> DataFrame:
    """Most starred young repositories, overall and for each language (``language_filter``).

    Every repository is offered to two slices at most, and each task keeps only its own best
    ``size`` per slice, so the overall slice does not gather all rows in one task.
    """
    since = (as_of - timedelta(days=days)).strftime("%Y-%m-%d")
    young = repos.filter(
        (F.substring("created_at", 1, 10).try_cast("date") > F.lit(since).cast("date"))
        & (F.col("stargazers_count") > min_stars)
    )
    language = F.lower("language")
    slices = F.array_compact(F.array(F.lit(REPO_ALL), F.when(language.isin(*languages), language)))
    offered = young.withColumn("language_filter", F.explode(slices))
    order = [F.col("stargazers_count").desc(), F.col("id")]
    return top_per_group(offered, ["language_filter"], order, size)


def flatten_repos(repos: DataFrame, at: datetime | None = None) -> DataFrame:
    """Nested repository payloads to message columns; missing values are 0, '' or []."""

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    flat = repos.select(
        F.col("id").alias("repo_id"),
        F.col("full_name").alias("repo_name"),
        F.col("html_url").alias("repo_url"),
        text("description").alias("description"),
        F.coalesce("stargazers_count", F.lit(0)).alias("stars"),
        F.coalesce("forks_count", F.lit(0)).alias("forks"),
        text("language").alias("language"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        text("created_at").alias("created_at"),
        text("updated_at").alias("updated_at"),
        text("owner.login").alias("owner"),
        "language_filter",
    )
    return with_ingest_metadata(flat, GITHUB, at)


def repo_messages(
    repos: DataFrame,
    as_of: datetime,
    languages: Sequence[str] = REPO_LANGUAGES,
    seen: DataFrame | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Trending repositories to messages: each once, the overall slice before the languages."""
    flat = flatten_repos(trending_repos(repos, as_of, languages), at)
    order = [_slice_order("language_filter", (REPO_ALL, *languages))]
    return first_seen(flat, "repo_id", order, seen)
