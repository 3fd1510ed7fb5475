"""Registered queries: each maps ``(spark, sf_dir)`` to a DataFrame over whole tables.

Queries of the Gold layer read Silver tables, and serving queries read Gold tables, as the
jobs do. :func:`warehouse` derives these tables from the given ones, once per application
and data folder, in the shared scratch folder.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.text import article_id, clean_text, clean_url, parse_timestamp, unified_id
from trendloom.operators.latest import first_seen, newest_per_key, top_per_group
from trendloom.operators.pivots import search_index, write_index
from trendloom.operators.vectors import cosine_topk
from trendloom.plans import enrich, gold, jobs, metrics, refresh, retrieval, serving, silver
from trendloom.schemas import FEEDS
from trendloom.session import scratch_root, shuffles_removed, use_utc
from trendloom.sources import feeds, messages, testdata
from trendloom.sources.tables import TableStore
from trendloom.streaming import bronze, dedup, keyed, slices, watch

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = testdata.AS_OF
CLOCKS = ("silver_processed_at", "gold_computed_at", "enriched_at", "bronze_ingested_at")

_registry: dict[str, Query] = {}
_ready: set[tuple[str, str, str]] = set()
_lock = threading.RLock()


# ---- shape of results -------------------------------------------------------------------


def comparable(df: DataFrame) -> DataFrame:
    """Plain values for comparison: zone-free timestamps, wide integers, joined lists, doubles to
    six digits (ties to even), no clock columns.
    """
    columns = []
    for field in df.schema.fields:
        if field.name in CLOCKS:
            continue
        name = f"`{field.name}`"
        kind = field.dataType
        if isinstance(kind, T.TimestampType):
            name = f"cast({name} as timestamp_ntz)"
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            name = f"cast({name} as bigint)"
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            name = f"rint({name} * 1000000.0D) / 1000000.0D"
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            name = f"array_join({name}, '|')"
        elif isinstance(kind, T.MapType):
            pairs = f"array_sort(map_entries({name}))"
            name = f"array_join(transform({pairs}, p -> concat(p.key, '=', p.value)), ';')"
        columns.append(f"{name} as `{field.name}`")
    return df.selectExpr(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(use_utc(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        _registry[name] = run
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_registry)


# ---- stored layers ----------------------------------------------------------------------


def _fresh_store(spark: SparkSession, purpose: str) -> TableStore:
    return TableStore(spark, f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}", "parquet")


def silver_of(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return silver.to_silver(testdata.RAW[feed](spark, sf_dir), feed, AS_OF)


def _write_silver(store: TableStore, sf_dir: str) -> None:
    """The Silver tables, side by side as in :func:`jobs.run_silver`: a feed of few tasks leaves cores to the others."""

    def feed_rows(feed: str) -> int:
        return store.upsert(silver_of(store.spark, sf_dir, feed), "silver", feed, "unified_id")

    def enriched_rows() -> int:
        return store.overwrite(testdata.enriched(store.spark, sf_dir), "silver", "enriched")

    jobs.side_by_side({**{feed: partial(feed_rows, feed) for feed in FEEDS}, "enriched": enriched_rows})


def warehouse(spark: SparkSession, sf_dir: str, layer: str) -> TableStore:
    """Store with the layers up to ``layer`` (``silver``, ``gold`` or ``documents``) of ``sf_dir``."""
    app = spark.sparkContext.applicationId
    place = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    store = TableStore(spark, f"{scratch_root(spark)}/tables-{place}", "parquet")
    steps = {
        "silver": lambda: _write_silver(store, sf_dir),
        "gold": lambda: jobs.run_gold(store, AS_OF),
        "documents": lambda: jobs.run_retrieval(store),
    }
    with _lock:
        for name, make in steps.items():
            if (app, place, name) not in _ready:
                make()
                _ready.add((app, place, name))
            if name == layer:
                return store
    raise ValueError(f"unknown layer {layer!r}")


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.load_combined(warehouse(spark, sf_dir, "silver"))


def gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse(spark, sf_dir, "gold").read("gold", name)


# ---- expressions ------------------------------------------------------------------------


@query("clean_text")
def _clean_text(spark, sf_dir):
    return testdata.table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned"))


@query("parse_timestamp")
def _parse_timestamp(spark, sf_dir):
    given = testdata.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """case event_type
             when 'click' then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
             when 'purchase' then date_format(ts, 'yyyy-MM-dd HH:mm:ss')
             when 'view' then cast(unix_seconds(cast(ts as timestamp)) as string)
             when 'signup' then 'n/a' else '' end as text""",
        "unix_seconds(cast(ts as timestamp)) as epoch",
    )
    return given.select(
        "event_id",
        parse_timestamp("text").alias("from_text"),
        parse_timestamp("epoch").alias("from_epoch"),
    )


@query("unified_id")
def _unified_id(spark, sf_dir):
    return testdata.table(spark, sf_dir, "events").select(
        "event_id",
        unified_id("hackernews", "event_id").alias("hn_id"),
        unified_id("github", "event_id").alias("github_id"),
    )


@query("clean_url")
def _clean_url(spark, sf_dir):
    news = testdata.news_raw(spark, sf_dir).selectExpr("concat('n', article_id) as item", "url")
    hn = testdata.hn_raw(spark, sf_dir).selectExpr("concat('h', id) as item", "url").distinct()
    return news.unionByName(hn).select("item", clean_url("url").alias("url"))


@query("drop_empty_titles")
def _drop_empty_titles(spark, sf_dir):
    return silver.drop_empty_titles(testdata.hn_raw(spark, sf_dir).selectExpr("id", "text as title"))


@query("dedup_latest")
def _dedup_latest(spark, sf_dir):
    return newest_per_key(testdata.table(spark, sf_dir, "events"), "user_id", "ts")


# ---- Bronze -----------------------------------------------------------------------------


def hn_messages(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Stories as JSON messages. ``error`` stories are cut short, ``signup`` scores are no numbers."""
    raw = testdata.hn_raw(spark, sf_dir, pieces).withColumn("unknown_field", F.lit("dropped"))
    body = F.to_json(F.struct("*"))
    typed = F.when(
        F.col("type") == "signup", F.regexp_replace(body, r'"score":-?\d+', '"score":"n/a"')
    ).when(F.col("type") == "error", F.substring_index(body, '"title"', 1)).otherwise(body)
    return _as_messages(raw, typed, "id", "hn-raw")


def _as_messages(raw: DataFrame, body, key: str, topic: str) -> DataFrame:
    return raw.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        parse_timestamp("ingested_at").alias("timestamp"),
    )


@query("bronze_parse")
def _bronze_parse(spark, sf_dir):
    rows = bronze.parse_messages(hn_messages(spark, sf_dir), FEEDS["hn"], AS_OF)
    return rows.withColumn("score", F.col("score").cast("double"))


def all_messages(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> dict[str, DataFrame]:
    """Messages of the three feeds, in so many pieces each if a number is given."""
    body = F.to_json(F.struct("*"))
    return {
        "hn": hn_messages(spark, sf_dir, pieces),
        "news": _as_messages(testdata.news_raw(spark, sf_dir, pieces), body, "article_id", "news-raw"),
        "github": _as_messages(testdata.github_raw(spark, sf_dir, pieces), body, "repo_id", "github-raw"),
    }


@query("bronze_news")
def _bronze_news(spark, sf_dir):
    return bronze.parse_messages(all_messages(spark, sf_dir)["news"], FEEDS["news"], AS_OF)


@query("bronze_github")
def _bronze_github(spark, sf_dir):
    return bronze.parse_messages(all_messages(spark, sf_dir)["github"], FEEDS["github"], AS_OF)


def _streams(store: TableStore, sf_dir: str) -> dict[str, DataFrame]:
    """The messages of the three feeds as file streams."""
    for feed, sent in all_messages(store.spark, sf_dir).items():
        sent.write.parquet(store.path("messages", feed))
    return {feed: messages.file_stream(store.spark, store.path("messages", feed)) for feed in FEEDS}


@query("bronze_stream")
def _bronze_stream(spark, sf_dir):
    """Messages of all feeds through the file source, the parse and the append sink; then the stored tables."""
    store = _fresh_store(spark, "stream")
    bronze.finish_feeds(bronze.start_feeds(
        _streams(store, sf_dir), store.path("bronze", ""), store.path("checkpoints", ""), every=None
    ))
    hn, news, github = (store.read("bronze", feed) for feed in FEEDS)
    common = ["url", "ingested_at", "source", "pipeline_version", "kafka_timestamp", "kafka_topic"]
    return reduce(DataFrame.unionByName, [
        hn.selectExpr("cast(id as string) as key", "title as name", "`text` as body", "cast(score as double) as points", *common),
        news.selectExpr("article_id as key", "title as name", "description as body", "cast(null as double) as points", *common),
        github.selectExpr("cast(repo_id as string) as key", "repo_name as name", "description as body", "cast(stars as double) as points", "repo_url as url", *common[1:]),
    ])


@query("first_seen_stream")
def _first_seen_stream(spark, sf_dir):
    """Ids of all feeds' streams, with re-sent messages, each once."""
    store, ids = _fresh_store(spark, "stream"), {"hn": "id", "news": "article_id", "github": "repo_id"}
    started = {}
    for feed, stream in _streams(store, sf_dir).items():
        once = dedup.first_seen_stream(bronze.parse_messages(stream, FEEDS[feed]), ids[feed], "kafka_timestamp", "40 days")
        started[feed] = bronze.start_append(
            once.select(F.col(ids[feed]).cast("string").alias("id")), store.path("first", feed), store.path("checkpoints", feed), every=None
        )
    bronze.finish_feeds(started)
    return reduce(DataFrame.union, [store.read("first", feed).select(F.lit(feed).alias("feed"), "id") for feed in FEEDS])


@query("stream_metrics")
def _stream_metrics(spark, sf_dir):
    """Messages of all feeds' streams by what became of them, told by a listener while the streams run."""
    store, heard = _fresh_store(spark, "stream"), watch.listen(spark)
    started = bronze.start_feeds(
        _streams(store, sf_dir), store.path("bronze", ""), store.path("checkpoints", ""), every=None, watch=True
    )
    bronze.finish_feeds(started)
    for stream in started.values():
        heard.wait_for(stream)
    spark.streams.removeListener(heard)
    return heard.table(spark)


def _files_a_trigger(spark: SparkSession) -> int:
    """Files of one trigger: one for each core, so that no trigger waits for a single task however large the files are."""
    return max(spark.sparkContext.defaultParallelism, 2)


@query("silver_stream")
def _silver_stream(spark, sf_dir):
    """Messages of all feeds straight into keyed Silver tables, in five triggers of a file or more for each core."""
    store, files, streams = _fresh_store(spark, "silver-stream"), _files_a_trigger(spark), {}
    for feed, sent in all_messages(spark, sf_dir, 5 * files).items():
        path = store.path("messages", feed)
        with shuffles_removed(spark):
            sent.write.parquet(path, compression="zstd")
        # A session may deal rows into more pieces than it is asked for; they are still five triggers.
        found = len(spark.read.schema("any int").parquet(path).inputFiles())
        streams[feed] = messages.file_stream(spark, path, max_files_per_trigger=max(files, -(-found // 5)), once=True)
    bronze.finish_feeds(keyed.start_silver(streams, store, store.path("checkpoints", ""), AS_OF, every=None, fan=3))
    return reduce(DataFrame.unionByName, [store.read("silver", feed) for feed in FEEDS])


@query("first_seen_slices")
def _first_seen_slices(spark, sf_dir):
    """Events of a user, held for two days for the best of their types, then remembered for five."""
    store, at = _fresh_store(spark, "slices"), F.col("ts").cast("timestamp")
    testdata.table(spark, sf_dir, "events").withColumn("ts", at).write.parquet(store.path("in", "events"))
    kind = spark.read.parquet(store.path("in", "events")).schema
    stream = spark.readStream.schema(kind).parquet(store.path("in", "events"))
    priority = F.expr("case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    slices.use_rocksdb(spark)
    best = slices.first_seen_by_priority(stream, "user_id", priority, "ts", "2 days", "5 days", "1 hour", "event_id")
    sent = bronze.start_append(best, store.path("first", "events"), store.path("checkpoints", "events"), every=None)
    sent.awaitTermination()
    spark.conf.set(provider, before)
    return store.read("first", "events").select("user_id", "event_id", "event_type", "ts")


@query("bronze_folded")
def _bronze_folded(spark, sf_dir):
    """Stories through the append sink in many small files, folded into parts between two runs of the stream.

    A run brings the messages of a third of the (key, time) hashes, in two triggers.
    """
    store, files = _fresh_store(spark, "folded"), _files_a_trigger(spark)
    sent, third = hn_messages(spark, sf_dir), F.pmod(F.xxhash64("key", "timestamp"), F.lit(3))
    for k in range(3):
        sent.filter(third == k).repartition(2 * files).write.mode("append").parquet(store.path("messages", "hn"))
        stream = messages.file_stream(spark, store.path("messages", "hn"), max_files_per_trigger=files)
        bronze.finish_feeds(bronze.start_feeds({"hn": stream}, store.path("bronze", ""), store.path("checkpoints", ""), every=None))
        if k < 2:  # the last files stay as the stream left them
            store.fold_stream("bronze", "hn", fan=2)
    rows = store.read("bronze", "hn")
    return rows.withColumn("score", F.col("score").cast("double"))


@query("rows_without_id")
def _rows_without_id(spark, sf_dir):
    """Mapped rows that Silver leaves out because nothing names them: messages that have lost their ids."""
    unnamed = {
        "hn": testdata.hn_raw(spark, sf_dir).withColumn("id", F.when(F.col("type") != "view", F.col("id"))),
        "news": testdata.news_raw(spark, sf_dir).withColumn("article_id", F.when(F.col("query_tag") != "Rust", F.col("article_id"))),
        "github": testdata.github_raw(spark, sf_dir),
    }
    return reduce(DataFrame.union, [
        metrics.rows_without_id(silver.map_feed(rows, feed, AS_OF)).select(F.lit(feed).alias("feed"), "rows")
        for feed, rows in unnamed.items()
    ])


# ---- feed selection ---------------------------------------------------------------------


@query("hn_feed")
def _hn_feed(spark, sf_dir):
    items = newest_per_key(testdata.hn_raw(spark, sf_dir), "id").withColumn(
        "type", F.when(F.col("type").isin("click", "view", "signup"), "story").otherwise("job")
    )
    sent = testdata.table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    order = [F.col("weight").desc(), F.col("id")]
    members = testdata.hn_feeds(spark, sf_dir)
    return feeds.hn_messages(items, members, order, sent.selectExpr("event_id as id"), AS_OF)


@query("hn_stories")
def _hn_stories(spark, sf_dir):
    items = testdata.hn_raw(spark, sf_dir).select("id", "ingested_at", F.col("text").alias("title")).withColumn(
        "type", F.when(F.get_json_object("title", "$.k").cast("int") >= 10, "story").otherwise("job")
    )
    return feeds.with_ingest_metadata(feeds.hn_stories(items), "hackernews", AS_OF)


@query("article_id")
def _article_id(spark, sf_dir):
    return testdata.table(spark, sf_dir, "pages").select("page_id", article_id("url").alias("article_id"))


@query("valid_articles")
def _valid_articles(spark, sf_dir):
    return feeds.valid_articles(testdata.news_payload(spark, sf_dir)).select("url", "title")


@query("flatten_articles")
def _flatten_articles(spark, sf_dir):
    return feeds.flatten_articles(testdata.news_payload(spark, sf_dir), AS_OF)


@query("newest_articles")
def _newest_articles(spark, sf_dir):
    return feeds.newest_articles(testdata.news_payload(spark, sf_dir)).select("url", "query", "publishedAt")


@query("trending_repos")
def _trending_repos(spark, sf_dir):
    chosen = feeds.trending_repos(testdata.repo_payload(spark, sf_dir), AS_OF)
    return chosen.select("id", "stargazers_count", "language_filter")


@query("flatten_repos")
def _flatten_repos(spark, sf_dir):
    payload = testdata.repo_payload(spark, sf_dir).withColumn("language_filter", F.lit("all"))
    return feeds.flatten_repos(payload, AS_OF)


@query("news_select")
def _news_select(spark, sf_dir):
    payload = testdata.news_payload(spark, sf_dir)
    return feeds.news_messages(payload, ("top", "python", "Rust"), at=AS_OF)


@query("repo_trending")
def _repo_trending(spark, sf_dir):
    return feeds.repo_messages(testdata.repo_payload(spark, sf_dir), AS_OF, at=AS_OF)


@query("first_seen")
def _first_seen(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    priority = F.expr("case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end")
    seen = events.filter(F.col("value") > 350)
    chosen = first_seen(events, "user_id", [priority, F.col("ts"), F.col("event_id")], seen)
    return chosen.select("user_id", "event_id", "event_type")


# ---- Silver -----------------------------------------------------------------------------


@query("silver_hn")
def _silver_hn(spark, sf_dir):
    return silver_of(spark, sf_dir, "hn")


@query("silver_news")
def _silver_news(spark, sf_dir):
    return silver_of(spark, sf_dir, "news")


@query("silver_github")
def _silver_github(spark, sf_dir):
    return silver_of(spark, sf_dir, "github")


@query("silver_combined")
def _silver_combined(spark, sf_dir):
    return combined(spark, sf_dir)


@query("upsert_silver")
def _upsert_silver(spark, sf_dir):
    """Stories of the first half month, then the rest upserted over them."""
    store = _fresh_store(spark, "upsert")
    raw = testdata.hn_raw(spark, sf_dir)
    early = F.col("ingested_at") < "2024-01-16"
    for part in (raw.filter(early), raw.filter(~early)):
        store.upsert(silver.to_silver(part, "hn", AS_OF), "silver", "hn", "unified_id")
    return store.read("silver", "hn")


@query("silver_layer")
def _silver_layer(spark, sf_dir):
    """The Silver job over stored Bronze tables, then rows and content of each table."""
    store = _fresh_store(spark, "silver")
    for feed, raw in testdata.RAW.items():
        store.append(raw(spark, sf_dir), "bronze", feed)
    jobs.run_silver(store, as_of=AS_OF)
    return metrics.layer_digests({feed: store.read("silver", feed).drop(*CLOCKS) for feed in FEEDS})


# ---- enrichment -------------------------------------------------------------------------


@query("enrich_candidates")
def _enrich_candidates(spark, sf_dir):
    store = warehouse(spark, sf_dir, "silver")
    return enrich.enrichment_candidates(jobs.silver_tables(store), store.read("silver", "enriched"))


@query("attach_enrichment")
def _attach_enrichment(spark, sf_dir):
    store = warehouse(spark, sf_dir, "silver")
    silver_rows = reduce(DataFrame.unionByName, [store.read("silver", f).select("unified_id", "title") for f in FEEDS])
    rows = gold.attach_enrichment(silver_rows, store.read("silver", "enriched"))
    return rows.select(
        "unified_id", "title", "sentiment", "ai_topics", "ai_entities", "enrichment_error"
    )


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a model as they come: plain, fenced, partial, broken, failed, no object, null or
    single values for lists, repeated names. The user's number picks among the variants of a type.
    """
    return testdata.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """case event_type
             when 'click' then concat('{"sentiment": "positive", "ai_topics": ["a","b","c","d","e"],',
                                      ' "entities": ["k', get_json_object(props, '$.k'), '"]}')
             when 'view' then case user_id % 6
                  when 0 then '[1, 2]' when 1 then '"hello"' when 2 then 'null'
                  when 3 then '{"sentiment": "positive", "entities": null}'
                  when 4 then '{"sentiment": "positive", "ai_topics": "rust", "sentiment": "negative"}'
                  else '```json\\n{"sentiment": "negative", "ai_topics": ["x"], "entities": []}\\n```' end
             when 'signup' then ' {"ai_topics": ["only"]} '
             when 'purchase' then 'sorry, {no JSON' end as raw""",
        "if(event_type = 'error', 'timeout', null) as failure",
    )


def _parsed_answers(spark, sf_dir):
    return enrich.parse_responses(model_answers(spark, sf_dir), "raw", "failure", F.lit(False))


@query("enrich_parse")
def _enrich_parse(spark, sf_dir):
    return _parsed_answers(spark, sf_dir)


@query("enrich_rows")
def _enrich_rows(spark, sf_dir):
    rows = testdata.news_raw(spark, sf_dir).select("article_id", "title", "description")
    return enrich.enrich(rows, as_of=AS_OF).select(
        "article_id", "sentiment", "ai_topics", "ai_entities", "enrichment_error"
    )


def faltering_model():
    """A model that refuses a text as many times in a row as its length modulo 4 says, then answers."""
    refused = {}

    def answer(text):
        times = refused.pop(text, 0) + 1
        if times <= len(text) % 4:
            if times < 3:
                refused[text] = times
            raise TimeoutError(f"refused {times} times")
        return json.dumps({"sentiment": "positive", "ai_topics": [f"asked {times} times"]})

    return answer


@query("enrich_retries")
def _enrich_retries(spark, sf_dir):
    """All news rows asked of a faltering service, with two retries for each."""
    rows = testdata.news_raw(spark, sf_dir).selectExpr("article_id", "title", "cast(null as string) as description")
    asked = enrich.enrich(rows, faltering_model, as_of=AS_OF, retries=2, backoff_seconds=0)
    return asked.select("article_id", "sentiment", "ai_topics", "enrichment_error")


@query("enrichment_run")
def _enrichment_run(spark, sf_dir):
    """Two runs of the enrichment job; the second goes on where the first ended."""
    source, target = warehouse(spark, sf_dir, "silver"), _fresh_store(spark, "enriched")
    for _ in range(2):
        jobs.run_enrichment(source, as_of=AS_OF, target=target)
    return target.read("silver", "enriched").select(
        "unified_id", "source", "title", "sentiment", "ai_topics", "enrichment_error", "llm_model"
    )


# ---- Gold -------------------------------------------------------------------------------


@query("trending_topics")
def _trending_topics(spark, sf_dir):
    return gold.trending_topics(combined(spark, sf_dir), AS_OF)


@query("language_momentum")
def _language_momentum(spark, sf_dir):
    return gold.language_momentum(combined(spark, sf_dir), AS_OF)


@query("source_activity")
def _source_activity(spark, sf_dir):
    return gold.source_activity(combined(spark, sf_dir), AS_OF)


@query("top_content")
def _top_content(spark, sf_dir):
    return gold.top_content(combined(spark, sf_dir), AS_OF)


@query("gold_layer")
def _gold_layer(spark, sf_dir):
    """The Gold job over stored Silver tables, then rows and content of each table."""
    store = _fresh_store(spark, "gold")
    jobs.run_gold(warehouse(spark, sf_dir, "silver"), AS_OF, target=store)
    return metrics.layer_digests({name: store.read("gold", name).drop(*CLOCKS) for name in jobs.BUILDERS})


def _refreshed(spark: SparkSession, sf_dir: str) -> TableStore:
    """Gold made from the first half of the month and then refreshed with the rest, once per application.

    Stories of the second half replace those of the first, and a third of the enrichment comes last.
    """
    app = spark.sparkContext.applicationId
    place = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    store = TableStore(spark, f"{scratch_root(spark)}/refreshed-{place}", "parquet")
    with _lock:
        if (app, place, "refreshed") not in _ready:
            known = testdata.enriched(spark, sf_dir)
            late = F.col("sentiment") == "negative"
            for early in (True, False):
                for feed in FEEDS:
                    raw = testdata.RAW[feed](spark, sf_dir)
                    first = F.col("ingested_at" if feed == "hn" else {"news": "published_at", "github": "created_at"}[feed]) < "2024-01-16"
                    part = raw.filter(first if early else ~first)
                    store.upsert(silver.to_silver(part, feed, AS_OF), "silver", feed, "unified_id")
                store.append(known.filter(~late if early else late), "silver", "enriched")
                refresh.refresh_gold(store, AS_OF)
            _ready.add((app, place, "refreshed"))
    return store


@query("refreshed_topics")
def _refreshed_topics(spark, sf_dir):
    return _refreshed(spark, sf_dir).read("gold", "trending_topics")


@query("refreshed_activity")
def _refreshed_activity(spark, sf_dir):
    return _refreshed(spark, sf_dir).read("gold", "source_activity")


@query("refreshed_momentum")
def _refreshed_momentum(spark, sf_dir):
    return _refreshed(spark, sf_dir).read("gold", "language_momentum")


@query("refreshed_content")
def _refreshed_content(spark, sf_dir):
    return _refreshed(spark, sf_dir).read("gold", "top_content")


# ---- retrieval --------------------------------------------------------------------------


@query("docs_content")
def _docs_content(spark, sf_dir):
    return retrieval.content_documents(gold_table(spark, sf_dir, "top_content"))


@query("docs_topics")
def _docs_topics(spark, sf_dir):
    return retrieval.topic_documents(gold_table(spark, sf_dir, "trending_topics"))


@query("docs_languages")
def _docs_languages(spark, sf_dir):
    return retrieval.language_documents(gold_table(spark, sf_dir, "language_momentum"))


def document_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.document_corpus(
        gold_table(spark, sf_dir, "top_content"),
        gold_table(spark, sf_dir, "trending_topics"),
        gold_table(spark, sf_dir, "language_momentum"),
    )


@query("document_corpus")
def _document_corpus(spark, sf_dir):
    return document_corpus(spark, sf_dir)


# The whole vector as text: place and value in millionths of all places but the empty ones. A value half-way
# between two millionths, such as 1/128, goes away from zero.
VECTOR_TEXT = (
    "array_join(filter(transform(embedding, (x, i) -> if(x = 0, null,"
    " concat(i, '=', cast(round(cast(x as double) * 1000000) as bigint)))), e -> e is not null), ' ')"
)


@query("embed_documents")
def _embed_documents(spark, sf_dir):
    vectors = retrieval.embed_documents(
        testdata.table(spark, sf_dir, "documents").select("doc_id", "text")
    )
    return vectors.select("doc_id", F.expr(VECTOR_TEXT).alias("embedding"))


@query("embed_remembered")
def _embed_remembered(spark, sf_dir):
    """English documents embedded first, then all; ``fresh`` texts were new to the second run."""
    store, docs = _fresh_store(spark, "vectors"), testdata.table(spark, sf_dir, "documents")
    retrieval.embed_remembered(docs.filter("lang = 'en'").select("doc_id", "text"), store, "words")
    known = store.version("work", "vectors")
    vectors = retrieval.embed_remembered(docs.select("doc_id", "text"), store, "words")
    digest = F.sha2(F.concat(F.lit("words\0"), F.coalesce("text", F.lit(""))), 256)
    first = store.read("work", "vectors", known).select(F.col("_digest").alias("digest"), F.lit(False).alias("fresh"))
    told = vectors.withColumn("digest", digest).join(first, "digest", "left")
    return told.select("doc_id", F.expr(VECTOR_TEXT).alias("embedding"), F.coalesce("fresh", F.lit(True)).alias("fresh"))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of every label, as the question asked of the vectors."""
    values = testdata.table(spark, sf_dir, "embeddings").selectExpr("label", "posexplode(embedding)")
    means = values.groupBy("label", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy("label").agg(ordered.alias("v")).select(
        F.col("label").alias("question_id"),
        F.col("v.mean").alias("embedding"),
        F.concat(F.lit("Which items are nearest to group "), F.col("label").cast("string"), F.lit("?"))
        .alias("question"),
    )


def _vectors(spark, sf_dir):
    return testdata.table(spark, sf_dir, "embeddings").selectExpr("vec_id as id", "embedding")


@query("cosine_topk")
def _cosine_topk(spark, sf_dir):
    return cosine_topk(centroids(spark, sf_dir), _vectors(spark, sf_dir))


@query("pivot_topk")
def _pivot_topk(spark, sf_dir):
    """Every twentieth vector asks all vectors, through an index of pivots."""
    corpus = _vectors(spark, sf_dir)
    asked = corpus.filter("id % 20 = 0").withColumnRenamed("id", "question_id")
    index = write_index(corpus, f"{scratch_root(spark)}/pivots-{uuid.uuid4().hex}")
    found = search_index(index, asked)
    hits = top_per_group(found, ["question_id"], [F.col("similarity").desc(), F.col("id")], 8, "place")
    return hits.withColumn("distance", F.lit(1.0) - F.col("similarity"))


def _label_contexts(spark, sf_dir):
    texts = testdata.table(spark, sf_dir, "documents").selectExpr("doc_id as id", "text", "source as type")
    hits = cosine_topk(
        centroids(spark, sf_dir), _vectors(spark, sf_dir), carry=("text", "type"), details=texts
    )
    return retrieval.contexts(hits)


@query("rag_context")
def _rag_context(spark, sf_dir):
    return _label_contexts(spark, sf_dir)


@query("rag_prompts")
def _rag_prompts(spark, sf_dir):
    return retrieval.prompts(_label_contexts(spark, sf_dir), centroids(spark, sf_dir))


def _asked(spark, sf_dir, responder=None):
    """Every user turn of the conversations, asked of the Gold documents."""
    turns = testdata.table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    questions = turns.selectExpr("concat(conv_id, '-', turn) as question_id", "text as question")
    corpus = warehouse(spark, sf_dir, "documents").read("gold", "documents")
    return retrieval.ask(questions, corpus, responder=responder)


@query("ask_questions")
def _ask_questions(spark, sf_dir):
    return _asked(spark, sf_dir).select("question_id", "prompt")


def measuring_responder():
    """A model that answers with the length of its prompt."""
    return lambda prompt: f"{len(prompt)} characters"


@query("ask_answers")
def _ask_answers(spark, sf_dir):
    return _asked(spark, sf_dir, measuring_responder).select("question_id", "answer", "answer_error")


# ---- serving ----------------------------------------------------------------------------


def _topics(spark, sf_dir):
    return serving.filter_topics(gold_table(spark, sf_dir, "trending_topics"))


def _languages(spark, sf_dir):
    return serving.filter_languages(gold_table(spark, sf_dir, "language_momentum"))


@query("summary_metrics")
def _summary_metrics(spark, sf_dir):
    store = warehouse(spark, sf_dir, "gold")
    return serving.run_summary(
        *[store.read("gold", n) for n in ("trending_topics", "top_content", "source_activity")],
        store.read("silver", "enriched"),
    )


@query("trending_view")
def _trending_view(spark, sf_dir):
    return serving.trending_view(gold_table(spark, sf_dir, "trending_topics"))


@query("momentum_view")
def _momentum_view(spark, sf_dir):
    return serving.momentum_view(gold_table(spark, sf_dir, "language_momentum"))


@query("activity_view")
def _activity_view(spark, sf_dir):
    return serving.activity_view(gold_table(spark, sf_dir, "source_activity"))


@query("content_view")
def _content_view(spark, sf_dir):
    return serving.content_view(gold_table(spark, sf_dir, "top_content"))


@query("activity_24h")
def _activity_24h(spark, sf_dir):
    return serving.recent_activity(gold_table(spark, sf_dir, "source_activity"))


@query("latest_top5")
def _latest_top5(spark, sf_dir):
    return serving.top_now(gold_table(spark, sf_dir, "trending_topics"))


@query("trend_filter")
def _trend_filter(spark, sf_dir):
    return serving.filter_topics(
        gold_table(spark, sf_dir, "trending_topics"), hours_back=72, min_sources=2, min_mentions=3
    )


@query("topn_latest")
def _topn_latest(spark, sf_dir):
    return serving.top_topics(_topics(spark, sf_dir))


@query("topic_series")
def _topic_series(spark, sf_dir):
    return serving.topic_series(_topics(spark, sf_dir))


@query("cross_source")
def _cross_source(spark, sf_dir):
    return serving.cross_source_topics(_topics(spark, sf_dir))


@query("topic_sentiment")
def _topic_sentiment(spark, sf_dir):
    return serving.topic_sentiment(_topics(spark, sf_dir))


@query("lang_leaderboard")
def _lang_leaderboard(spark, sf_dir):
    return serving.language_leaders(_languages(spark, sf_dir))


@query("lang_table")
def _lang_table(spark, sf_dir):
    momentum = serving.momentum_view(gold_table(spark, sf_dir, "language_momentum"))
    return serving.filter_languages(momentum, 14)


@query("lang_series")
def _lang_series(spark, sf_dir):
    return serving.language_series(_languages(spark, sf_dir))


@query("stars_mentions")
def _stars_mentions(spark, sf_dir):
    return serving.stars_and_mentions(_languages(spark, sf_dir))


@query("content_filter")
def _content_filter(spark, sf_dir):
    return serving.filter_content(gold_table(spark, sf_dir, "top_content"), "github", "Python")


@query("score_distribution")
def _score_distribution(spark, sf_dir):
    return serving.popularity_distribution(gold_table(spark, sf_dir, "top_content"))


@query("items_by_source")
def _items_by_source(spark, sf_dir):
    return serving.items_by_source(gold_table(spark, sf_dir, "top_content"))


@query("unique_titles")
def _unique_titles(spark, sf_dir):
    return serving.unique_titles(serving.filter_content(gold_table(spark, sf_dir, "top_content")))


# ---- run metrics ------------------------------------------------------------------------


@query("layer_counts")
def _layer_counts(spark, sf_dir):
    store = warehouse(spark, sf_dir, "gold")
    names = [("silver", n) for n in (*FEEDS, "enriched")]
    names += [("gold", n) for n in (*jobs.BUILDERS, "absent")]
    return metrics.layer_counts(
        spark, {f"{layer}/{name}": store.read_if_exists(layer, name) for layer, name in names}
    )


@query("sentiment_distribution")
def _sentiment_distribution(spark, sf_dir):
    return metrics.sentiment_distribution(combined(spark, sf_dir))


@query("error_rate")
def _error_rate(spark, sf_dir):
    return metrics.enrichment_errors(_parsed_answers(spark, sf_dir))
