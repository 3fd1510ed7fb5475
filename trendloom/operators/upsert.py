"""Keyed upsert: of rows that share a key, the one written last counts, or the one with the largest stamp."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.latest import newest_per_key


def last_written(parts: Sequence[DataFrame], key: str, stamp: str | None = None) -> DataFrame:
    """The rows of all ``parts``, oldest first, without those whose key a later part has again.

    Keys are unique within a part, so a key has at most one row per part, and a group is no larger
    than the number of parts. Columns that only some parts have are null elsewhere. With ``stamp``
    the order of the parts is of no account: of a key the row with the largest stamp stays, and equal
    stamps are settled by the other columns.
    """
    if len(parts) == 1:
        return parts[0]
    if stamp is not None:
        return newest_per_key(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), key, stamp)
    numbered = [df.withColumn("_part", F.lit(k)) for k, df in enumerate(parts)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    newest = Window.partitionBy(key).orderBy(F.col("_part").desc())
    return union.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_part", "_place")
