"""First-seen filtering of a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_seen_stream(
    stream: DataFrame, key: str, event_time: str = "timestamp", horizon: str = "1 day"
) -> DataFrame:
    """Emit each key once. Keys are remembered in the checkpoint, for ``horizon`` of event time.

    State is partitioned by key and dropped behind the watermark, so it does not grow without
    bound. A key that returns after the horizon is emitted again; Silver's upsert absorbs it.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
