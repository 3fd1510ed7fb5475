"""Adapters that give the test tables the shape of the three feeds.

``FIXTURES.md`` holds the same mappings as SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from trendloom.schemas import (
    GITHUB,
    GITHUB_SCHEMA,
    HACKERNEWS,
    HN_SCHEMA,
    NEWS_SCHEMA,
    NEWSAPI,
    PIPELINE_VERSION,
)

AS_OF = datetime(2024, 1, 31)
INGESTED_AT = "2024-01-31T00:00:00+00:00"
_MINUTES = 43200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dealt(df: DataFrame, pieces: int | None, *keys: str) -> DataFrame:
    """The rows in ``pieces`` partitions by a hash of ``keys``, if a number is given. Rows of the tables are a
    fraction of the messages that are made from them, and no task sorts them for that.
    """
    return df if pieces is None else df.repartition(pieces, *keys)


def _conform(df: DataFrame, schema) -> DataFrame:
    """The schema's columns in order and type; columns the adapter lacks are typed nulls."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"cast({f'`{f.name}`' if f.name in have else 'null'} as {f.dataType.simpleString()}) as `{f.name}`"
        for f in schema.fields
    ])


def _spread(key: str, step: int) -> str:
    """A minute of January 2024 for a row number, as ISO text."""
    minute = f"make_dt_interval(0, 0, cast({key} * {step} % {_MINUTES} as int))"
    return f"date_format(timestamp_ntz'2024-01-01 00:00:00' + {minute}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def hn_raw(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Events as stories; every ``view`` is sent again an hour later with a higher score."""
    sent = table(spark, sf_dir, "events").selectExpr(
        "*", "explode(if(event_type = 'view', array(0, 1), array(0))) as rev"
    )
    stories = _dealt(sent, pieces, "event_id", "user_id", "ts", "rev").selectExpr(
        "event_id as id",
        "event_type as type",
        "concat('user', user_id) as `by`",
        "concat('  ', event_type, '  by user ', user_id) as title",
        "case event_type when 'error' then 'https://removed.com'"
        " when 'signup' then concat('ftp://x/', event_id)"
        " else concat('https://hn.example.com/', event_id) end as url",
        "cast(floor(value) as int) + rev as score",
        "cast(get_json_object(props, '$.k') as int) as descendants",
        "unix_seconds(cast(ts as timestamp)) as time",
        "if(event_type = 'purchase', '   ', props) as text",
        "date_format(ts + make_dt_interval(0, rev), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") as ingested_at",
        f"'{HACKERNEWS}' as source",
        f"'{PIPELINE_VERSION}' as pipeline_version",
    )
    return _conform(stories, HN_SCHEMA)


def news_raw(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Documents as articles: first line as title, whole text as description."""
    pages = _dealt(table(spark, sf_dir, "pages").selectExpr("page_id as doc_id", "url"), pieces, "doc_id")
    documents = _dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), pieces, "doc_id")
    articles = documents.join(pages, "doc_id", "left").selectExpr(
        "md5(concat('doc_', doc_id)) as article_id",
        "substring_index(text, '\n', 1) as title",
        "text as description",
        "coalesce(url, concat('https://removed.com/', doc_id)) as url",
        f"{_spread('doc_id', 53)} as published_at",
        "concat(' ', source, ' ') as author",
        "source as source_name",
        "case lang when 'en' then 'python' when 'de' then 'Rust' when 'fr' then ''"
        " when 'es' then 'click' end as query_tag",
        f"'{INGESTED_AT}' as ingested_at",
        f"'{NEWSAPI}' as source",
        f"'{PIPELINE_VERSION}' as pipeline_version",
    )
    return _conform(articles, NEWS_SCHEMA)


def github_raw(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Parts as repositories."""
    repos = _dealt(table(spark, sf_dir, "part"), pieces, "p_partkey", "p_name").selectExpr(
        "p_partkey as repo_id",
        "concat(replace(p_name, ' ', '/'), p_partkey) as repo_name",
        "concat('https://git.example.com/', p_partkey) as repo_url",
        "concat(p_brand, ' ', p_type) as description",
        "cast(floor(p_retailprice) as int) as stars",
        "p_size as forks",
        "case p_type when 'ECONOMY' then 'Python' when 'SMALL' then 'rust' when 'MEDIUM' then 'Go'"
        " when 'PROMO' then '  ' when 'LARGE' then 'sql' end as language",
        "case when p_size % 5 = 0 then concat(split(p_name, ' '), array('error'))"
        " when p_size % 7 != 0 then split(p_name, ' ') end as topics",
        f"{_spread('p_partkey', 37)} as created_at",
        "p_brand as owner",
        f"'{INGESTED_AT}' as ingested_at",
        f"'{GITHUB}' as source",
        f"'{PIPELINE_VERSION}' as pipeline_version",
    )
    return _conform(repos, GITHUB_SCHEMA)


RAW = {"hn": hn_raw, "news": news_raw, "github": github_raw}


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of labelled articles and of purchase, error and signup stories.

    Toxic articles and error stories were enriched twice; the older result differs in every column.
    """
    labels = table(spark, sf_dir, "labels").selectExpr(
        "md5(concat('newsapi_', md5(concat('doc_', doc_id)))) as unified_id",
        "case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'neutral' end"
        " as sentiment",
        "if(quality = 1, array('prose', if(toxic = 1, 'insults', 'news')), array()) as ai_topics",
        "if(toxic = 1, array('somebody'), array()) as ai_entities",
        "if(quality = 0, 'json_parse_error', null) as enrichment_error",
        "toxic = 1 as twice",
    )
    stories = table(spark, sf_dir, "events").where("event_type in ('purchase', 'error', 'signup')").selectExpr(
        "md5(concat('hackernews_', event_id)) as unified_id",
        "case event_type when 'purchase' then 'positive' when 'error' then 'negative'"
        " else 'neutral' end as sentiment",
        "array(event_type) as ai_topics",
        "if(event_type = 'purchase', array('shop', 'card'), array()) as ai_entities",
        "cast(null as string) as enrichment_error",
        "event_type = 'error' as twice",
    )
    newest = labels.unionByName(stories)
    older = newest.where("twice").selectExpr(
        "unified_id", "'positive' as sentiment", "array('old') as ai_topics", "array('old') as ai_entities",
        "'timeout' as enrichment_error", "timestamp '2024-01-30' as enriched_at",
    )
    return newest.selectExpr("* except (twice)", "timestamp '2024-01-31' as enriched_at").unionByName(older)


# ---- payloads as the feeds deliver them, before selection -------------------------------


def hn_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership of the ``top`` feed (highest value first) and the ``new`` feed (latest first)."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as id",
        "inline(array(struct('top' as feed, value as weight),"
        " struct('new' as feed, cast(unix_micros(cast(ts as timestamp)) as double) as weight)))",
    ).select("feed", "id", "weight")


def news_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested articles with the query that returned them, removed ones included."""
    return news_raw(spark, sf_dir).selectExpr(
        "if(query_tag = 'click', '[Removed]', title) as title",
        "description",
        "url",
        "published_at as publishedAt",
        "if(query_tag = 'Rust', null, author) as author",
        "struct(cast(null as string) as id, source_name as name) as source",
        "if(query_tag = '', 'top', query_tag) as query",
    )


def repo_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested repositories as a search returns them."""
    return github_raw(spark, sf_dir).selectExpr(
        "repo_id as id",
        "repo_name as full_name",
        "repo_url as html_url",
        "description",
        "stars as stargazers_count",
        "forks as forks_count",
        "language",
        "topics",
        "created_at",
        "updated_at",
        "struct(owner as login, 'User' as type) as owner",
    )
