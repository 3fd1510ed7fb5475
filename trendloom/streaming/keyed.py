"""Streams into keyed tables: Silver kept up to date from the feeds' messages, batch by batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trendloom.plans.silver import to_silver
from trendloom.schemas import FEEDS
from trendloom.session import shuffles_removed
from trendloom.sources.tables import FAN, TableStore
from trendloom.streaming.bronze import parse_messages


def stream_identity(store: TableStore, checkpoint: str) -> str:
    """The name that Spark gave the query of a checkpoint. It outlives restarts, and a new checkpoint,
    which counts its batches from 0 again, has another one.
    """
    stream = store._fs(checkpoint).open(store._at(checkpoint, "metadata"))
    try:
        return json.loads(store.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_upsert(
    rows: DataFrame,
    store: TableStore,
    layer: str,
    name: str,
    key: str,
    checkpoint: str,
    stamp: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = "30 seconds",
    fan: int = FAN,
) -> StreamingQuery:
    """Upsert each trigger of a stream into a keyed table; ``every=None`` handles what is there and stops.

    ``prepare`` makes a trigger's rows into updates with unique keys. The table's version keeps the
    number of the batch, so a batch that Spark repeats, because the driver was lost between the
    write and the checkpoint, is applied once. With ``stamp`` rows may come in any order: of a key
    the one with the largest stamp counts. Parts are folded as they come, so that reads stay cheap.
    A trigger removes its shuffle files, so that the disk need not hold those of all triggers.
    """

    def apply(batch: DataFrame, number: int) -> None:
        own = store.within(batch.sparkSession)  # the stream's session, whose settings no other query sees
        with shuffles_removed(own.spark):
            updates = batch if prepare is None else prepare(batch)
            own.upsert(updates, layer, name, key, stamp, (stream_identity(store, checkpoint), number))
            own.fold(layer, name, fan)

    stream = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return stream.trigger(**({"availableNow": True} if every is None else {"processingTime": every})).start()


def start_silver(
    sources: Mapping[str, DataFrame],
    store: TableStore,
    checkpoint_root: str,
    as_of: datetime | None = None,
    every: str | None = "30 seconds",
    fan: int = FAN,
) -> dict[str, StreamingQuery]:
    """Messages to Silver without a run in between: one query per feed, each trigger cleaned, cut to the
    newest row of each id and upserted. A late message never replaces a newer row.
    """
    return {
        feed: start_upsert(
            parse_messages(messages, FEEDS[feed], as_of), store, "silver", feed, "unified_id",
            f"{checkpoint_root.rstrip('/')}/{feed}", "ingested_at", partial(to_silver, feed=feed, as_of=as_of), every, fan,
        )
        for feed, messages in sources.items()
    }
