"""Messages to Bronze. The parse is one function for streams and for stored messages."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendloom.functions._cols import columns_of
from trendloom.plans.silver import processing_time
from trendloom.schemas import FEEDS, INGEST_DAY, Feed
from trendloom.streaming.watch import watched


def parse_messages(
    messages: DataFrame, feed: Feed, as_of: datetime | None = None, watch: bool = False
) -> DataFrame:
    """JSON bytes to the feed's typed columns, with broker time, processing time and topic.

    Unknown fields are dropped, missing or ill-typed ones are null. A message that lacks a
    required field, or is no JSON at all, is left out. With ``watch`` the messages are counted as they
    pass, for :class:`trendloom.streaming.watch.FeedMetrics`.
    """
    text = F.col("value").cast("string")
    body = F.from_json(text, feed.schema)
    if watch:
        # A failed parse leaves its text in the corrupt record's column; other columns are not needed for that.
        kept = F.from_json(text, "_corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
        whole = text.rlike(r"^\s*\{") & kept.isNotNull() & kept["_corrupt"].isNull()
        opened = messages.select("timestamp", F.coalesce(whole, F.lit(False)).alias("_whole"), columns_of(body))
        rows = watched(opened, feed, "_whole")
    else:
        rows = messages.select("timestamp", columns_of(body))
    rows = rows.select(
        *feed.schema.names,
        F.col("timestamp").alias("kafka_timestamp"),
        processing_time(as_of).alias("bronze_ingested_at"),
        F.lit(feed.topic).alias("kafka_topic"),
    )
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in feed.required])
    return rows.filter(complete)


def start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "30 seconds",
    fmt: str = "parquet",
    by_day: bool = False,
) -> StreamingQuery:
    """Append a stream to a table. ``every=None`` handles what is there and stops.

    ``checkpoint`` must survive a restart; the query resumes from it. ``by_day`` partitions the
    table by ingest day, so that incremental Silver runs skip older days.
    """
    writer = rows
    if by_day:
        writer = rows.withColumn(INGEST_DAY, F.to_date("bronze_ingested_at"))
    stream = writer.writeStream.format(fmt).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if fmt == "delta":
        stream = stream.option("mergeSchema", "true")
    if by_day:
        stream = stream.partitionBy(INGEST_DAY)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return stream.trigger(**trigger).start(path)


def start_feeds(
    sources: Mapping[str, DataFrame],
    bronze_root: str,
    checkpoint_root: str,
    every: str | None = "30 seconds",
    fmt: str = "parquet",
    by_day: bool = False,
    watch: bool = False,
) -> dict[str, StreamingQuery]:
    """Start one query per feed on the session of the sources; Spark runs them side by side."""
    return {
        name: start_append(
            parse_messages(messages, FEEDS[name], watch=watch),
            f"{bronze_root.rstrip('/')}/{name}",
            f"{checkpoint_root.rstrip('/')}/{name}",
            every, fmt, by_day,
        )
        for name, messages in sources.items()
    }


def await_feeds(
    spark: SparkSession, queries: Mapping[str, StreamingQuery], check_seconds: int = 10
) -> None:
    """Block until one of the queries ends, then stop the others. An interrupt stops all; the
    error of a failed query is raised. Queries of the session that ended earlier are of no account.
    """
    spark.streams.resetTerminated()
    try:
        while all(query.isActive for query in queries.values()):
            spark.streams.awaitAnyTermination(check_seconds)
            spark.streams.resetTerminated()
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()
    for query in queries.values():
        error = query.exception()
        if error is not None:
            raise error


def finish_feeds(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for bounded (``every=None``) queries to end."""
    for query in queries.values():
        query.awaitTermination()
