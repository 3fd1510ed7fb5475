"""Metrics of running streams: rows read, kept, rejected and late, per feed."""

from __future__ import annotations

import threading
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from trendloom.schemas import Feed

#: Names of the counts. ``malformed`` messages are no JSON object, ``incomplete`` ones lack a required field.
COUNTS = ("read", "malformed", "incomplete")


def watched(opened: DataFrame, feed: Feed, body: str) -> DataFrame:
    """Count the opened messages of a feed as they pass; ``body`` tells which were a JSON object at all."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in feed.required])
    return opened.observe(
        f"feed {feed.name}",
        F.count(F.lit(1)).alias("read"), F.count_if(~F.col(body)).alias("malformed"),
        F.count_if(F.col(body) & ~complete).alias("incomplete"),
    )


class FeedMetrics(StreamingQueryListener):
    """Sums the counts of all batches that end while it listens; ``table`` gives them as rows.

    ``late`` counts the rows that came behind the watermark. A batch that Spark repeats after a failure
    is counted when it ends, which is once.
    """

    def __init__(self) -> None:
        self.lock, self.sums, self.last = threading.Condition(), {}, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        for name, row in progress.observedMetrics.items():
            if not name.startswith("feed "):
                continue
            with self.lock:
                sums = self.sums.setdefault(name.removeprefix("feed "), Counter())
                sums.update({c: row[c] or 0 for c in COUNTS})
                sums["late"] += late
        with self.lock:
            self.last[str(progress.runId)] = progress.batchId
            self.lock.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the last batch of ``query`` is counted; Spark tells of a batch a little after it ends."""
        told = query.lastProgress
        if told is not None:
            with self.lock:
                self.lock.wait_for(lambda: self.last.get(str(query.runId), -1) >= told["batchId"], seconds)

    def table(self, spark: SparkSession) -> DataFrame:
        """``feed, read, malformed, incomplete, late, kept`` for each feed that has been heard of."""
        with self.lock:
            rows = [
                (feed, s["read"], s["malformed"], s["incomplete"], s["late"], s["read"] - s["malformed"] - s["incomplete"])
                for feed, s in sorted(self.sums.items())
            ]
        return spark.createDataFrame(rows, "feed string, read long, malformed long, incomplete long, late long, kept long")


def listen(spark: SparkSession) -> FeedMetrics:
    """Metrics of all streams of the session from now on; ``spark.streams.removeListener`` ends it."""
    metrics = FeedMetrics()
    spark.streams.addListener(metrics)
    return metrics
