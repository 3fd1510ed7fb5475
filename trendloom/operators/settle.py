"""Results written once and counted, so that later steps can go by their size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendloom.session import scratch_root


def settle(df: DataFrame) -> tuple[DataFrame, int]:
    """The same rows read back from the shared scratch folder, and how many they are.

    The written table cuts the lineage: a lost executor does not repeat the work behind it.
    """
    seen = Observation()
    target = f"{scratch_root(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target), seen.get["rows"]
