"""First seen with slice priority on a stream: a key is held for a while, and its best slice is sent."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MILLIS = 1000
#: Times in a kept row, to the microsecond.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class HeldKeys(StatefulProcessor):
    """Periods of a key: it is held from its first row on, its best row is sent when ``hold`` is over, and
    further rows are dropped until ``remember`` is over as well. Then it is forgotten.

    The state of a key is a short list of its open periods. A key waits for one timer on event time, that
    of the first period to be sent or forgotten; all that is over by then is settled at once.
    """

    def __init__(self, hold: int, remember: int):
        self.hold, self.remember = hold, remember

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "periods string")

    def _periods(self) -> list[dict]:
        kept = self.open.get()
        return json.loads(kept[0]) if kept else []

    def _keep(self, periods: list[dict]) -> None:
        if periods:
            self.open.update((json.dumps(periods),))
        else:
            self.open.clear()

    def _next(self, periods: list[dict]) -> int | None:
        """Millisecond of the next thing to do, for which a timer is set."""
        return min(((self._end if p["body"] is None else self._due)(p["from"]) for p in periods), default=None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """A trigger's rows of the key, by time. The limits of the source on a trigger bound them."""
        found = sorted(row for part in rows for row in zip(part["at"].tolist(), part["best"].tolist(), part["body"].tolist()))
        periods = self._periods()
        before = self._next(periods)
        for at, best, body in found:
            own = next((p for p in reversed(periods) if p["from"] <= at), periods[0] if periods else None)
            if own is None or at > own["from"] + self.hold + self.remember:
                periods.append({"from": at, "best": best, "body": body})
                periods.sort(key=lambda p: p["from"])
            elif at <= own["from"] + self.hold and own["body"] is not None and best < own["best"]:
                own.update(best=best, body=body)
        self._keep(periods)
        if (first := self._next(periods)) != before:
            self.handle.registerTimer(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Send what is due, forget what has ended, and wait for the next of both.

        Rows up to the watermark come no more, so everything before it is settled with the first timer.
        """
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        periods = self._periods()
        if not periods or self._next(periods) > now:
            return
        kept, sent = [], []
        for period in periods:
            if period["body"] is not None and self._due(period["from"]) <= now:
                sent.append(period["body"])
                period = {"from": period["from"], "best": None, "body": None}
            if period["body"] is not None or self._end(period["from"]) > now:
                kept.append(period)
        self._keep(kept)
        if kept:
            self.handle.registerTimer(self._next(kept))
        if sent:
            yield pd.DataFrame({"body": sent})

    def _due(self, at: int) -> int:
        """Millisecond in which a period that begins at ``at`` is sent."""
        return -(-(at + self.hold) // MILLIS)

    def _end(self, at: int) -> int:
        """Millisecond in which it is forgotten, later than it is sent."""
        return max(-(-(at + self.hold + self.remember) // MILLIS), self._due(at) + 1)

    def close(self) -> None:
        pass


def micros(interval: str) -> Column:
    """Length of an interval such as ``1 day`` in microseconds."""
    return F.expr(f"unix_micros(timestamp_micros(0) + interval {interval})")


def first_seen_by_priority(
    stream: DataFrame, key: str, priority: Column, event_time: str = "timestamp", hold: str = "1 hour",
    remember: str = "1 day", late: str = "10 minutes", ties: str | None = None,
) -> DataFrame:
    """Rows of ``stream``, one per key and period: of those that come within ``hold`` of the key's
    first row, the one with the lowest ``priority`` (0 or more, null is last), then the earliest, then the
    lowest ``ties``.

    A row is sent when the watermark, ``late`` behind the newest row, passes the end of ``hold``. Then
    the key is remembered, and its rows are dropped, for ``remember``. So the state holds the keys of
    that time only. Rows without a key or a time are left out. All times are event times, so a
    restart, or another cut into triggers, sends the same rows as long as rows come in time. The
    session needs the RocksDB state store (:func:`use_rocksdb`).
    """
    spark = stream.sparkSession
    spans = spark.range(1).select(micros(hold).alias("hold"), micros(remember).alias("remember")).first()
    rows = stream.withWatermark(event_time, late).filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    # Priority, time and ties as one text that sorts like them; numbers are padded and never negative.
    tie = F.lit("") if ties is None else F.coalesce(F.col(ties).cast("string"), F.lit("~"))
    if ties is not None and isinstance(stream.schema[ties].dataType, T.IntegralType):
        tie = F.lpad(tie, 20, "0")
    rank = F.coalesce(priority.cast("long"), F.lit(2**63 - 1))
    best = F.concat_ws("|", F.lpad(rank.cast("string"), 20, "0"), F.lpad(at.cast("string"), 20, "0"), tie)
    narrow = rows.select(
        F.col(key).cast("string").alias("key"), F.col(event_time).alias("time"), at.alias("at"), best.alias("best"),
        F.to_json(F.struct("*"), TIMES).alias("body"),
    )
    sent = narrow.groupBy("key").transformWithStateInPandas(
        statefulProcessor=HeldKeys(spans["hold"], spans["remember"]), outputStructType="body string",
        outputMode="append", timeMode="eventTime",
    )
    return sent.select(F.from_json("body", stream.schema, TIMES).alias("row")).select("row.*")


def use_rocksdb(spark) -> None:
    """State with timers needs this state store; queries that start from now on use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
