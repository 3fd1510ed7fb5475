"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def newest_per_key(
    df: DataFrame, key: str, stamp: str = "ingested_at", ties: Sequence[str] | None = None
) -> DataFrame:
    """Keep the newest row of every key.

    Equal stamps are settled by ``ties``, or by all remaining columns if none are named; naming
    them lets Spark leave unused columns in storage. Filtering a row number makes Spark cut each
    key to one row before the shuffle (WindowGroupLimit), so a key that holds a third of the
    input sends one row per task.
    """
    if ties is None:
        ties = [f.name for f in df.schema.fields if f.name not in (key, stamp) and _sortable(f)]
    order = [F.col(stamp).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]]
    return first_per_group(df, [key], order)


def first_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, groups, order, 1)


def top_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    k: int,
    position: str | None = None,
) -> DataFrame:
    """First ``k`` rows of each group; ``order`` should be total. ``position`` keeps the place."""
    name = position or "_position"
    window = Window.partitionBy(*groups).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return kept if position else kept.drop(name)


def first_seen(
    df: DataFrame,
    key: str,
    priority: Sequence[Column],
    seen: DataFrame | None = None,
) -> DataFrame:
    """Emit every key once: the slice with the best priority wins, known keys are left out.

    ``seen`` is a table of keys sent earlier. It is matched after the cut to one row per key.
    """
    fresh = first_per_group(df.filter(F.col(key).isNotNull()), [key], priority)
    if seen is None:
        return fresh
    return fresh.join(seen.select(key), key, "left_anti")
