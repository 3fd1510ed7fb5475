"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants. Partition counts are left to AQE: it starts from the
# cluster's own `spark.sql.shuffle.partitions` and merges small partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites recorded for every Column cost several JVM round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffle files go when the step that made them has ended. Without it they stay until the driver collects
# its garbage, which an idle driver may not do for half an hour.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}
_lock = threading.Lock()


def create_session(app_name: str = "trendloom", **conf: str) -> SparkSession:
    """Build (or reuse) a session; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Hour and day windows are UTC windows, whatever zone the session came with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Steps that are planned inside remove their shuffle files when they have ended."""
    before = spark.conf.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a ``local`` master may
    fall back to a temporary folder, because there driver and executors share a disk.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    with _lock:
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        return _local_scratch[app]
