"""Exact ``rank()`` that does not bring the rows of a group into one task.

Ranks are worked out over the distinct scores of a group, with counts, and are cut into bands or
ranges. The rank of a score is its place there plus the number of rows above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.settle import settle

BANDS_PER_OCTAVE = 32


def score_band(score: Column) -> Column:
    """A whole number that never falls as the score grows; null for a null score.

    One band spans about 2 % of a score's size and there are at most 65,536 + 1 of them over
    the whole double range, whatever the data.
    """
    size = F.floor(F.log2(F.lit(1.0) + F.abs(score)) * BANDS_PER_OCTAVE)
    return F.signum(score).cast("int") * size.cast("int")


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on null-safe equality of ``keys``; the left side's columns come first.

    The right side is usually derived from the left one, so its keys are renamed.
    """
    renamed = right.withColumnsRenamed({c: f"_key_{c}" for c in keys})
    same = F.expr(" and ".join(f"`{c}` <=> `_key_{c}`" for c in keys))
    return left.join(renamed, same).drop(*[f"_key_{c}" for c in keys])


def _rows_above(count: str, groups: Sequence[str], order: str) -> Column:
    """Sum of ``count`` over the entries of the group placed before the current one."""
    window = (
        Window.partitionBy(*groups)
        .orderBy(F.col(order).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(count).over(window), F.lit(0))


def rank_by_score(
    rows: DataFrame, groups: Sequence[str], score: str, rank: str, sized: DataFrame | None = None
) -> DataFrame:
    """``rows`` plus ``rank() over (partition by groups order by score desc nulls last)``.

    Ranks are worked out over distinct scores, so rows that tie are one row with a count before any
    window, however many they are; ties collapse within each task. A group's scores are cut into
    bands. Rows meet their rank by a join on group and score, which AQE splits where it is skewed.
    ``sized`` gives the same groups and scores from a cheaper plan, if there is one.
    """
    histogram = score_histogram(rows if sized is None else sized, groups, score)
    banded = histogram.select("*", score_band(F.col(score)).alias("_band"))
    bands = banded.groupBy(*groups, "_band").agg(F.sum("_rows").alias("_band_rows"))
    offsets = bands.select(*groups, "_band", _rows_above("_band_rows", groups, "_band").alias("_above"))
    inside = banded.select("*", _rows_above("_rows", [*groups, "_band"], score).alias("_inside"))
    ranked = _match(inside, offsets, [*groups, "_band"])
    return _match(rows, ranked.select(*groups, score, _rank_after(F.expr("_above + _inside"), rank)), [*groups, score])


def score_histogram(rows: DataFrame, groups: Sequence[str], score: str) -> DataFrame:
    """Row count of each distinct score. Ties collapse in the map-side partial aggregation."""
    return rows.groupBy(*groups, score).agg(F.count(F.lit(1)).alias("_rows"))


def in_ranges(df: DataFrame, order: Sequence[Column], name: str = "_range") -> DataFrame:
    """``df`` stored in ranges of ``order``, each with its number.

    Ranges come from a sample of the data, so they are even whatever the values are. They are stored,
    because a second run might cut them elsewhere.
    """
    ranged = df.repartitionByRange(*order)
    return settle(ranged.withColumn(name, F.spark_partition_id()))[0]


def _rank_after(above: Column, name: str) -> Column:
    return (above + 1).cast("int").alias(name)


def leaders(
    rows: DataFrame, group: str, score: str, k: int, group_rank: str, overall_rank: str
) -> DataFrame:
    """Rows whose rank within ``group`` is at most ``k`` (ties kept), with that rank and the rank
    over all rows.

    The first pass reads only ``group`` and ``score`` and stores a histogram of distinct scores in
    even ranges. The rank of a score is its place in its range plus the rows of the ranges above.
    The second pass matches the full rows against the at most ``k`` scores per group.
    """
    descending = F.col(score).desc_nulls_last()
    histogram = in_ranges(score_histogram(rows, [group], score), [descending])
    place = Window.partitionBy(group).orderBy(descending)
    best = (
        histogram.select("*", F.row_number().over(place).alias("_place"))
        .filter(F.col("_place") <= k)
        .select(group, score, _rank_after(_rows_above("_rows", [group], score), group_rank))
        .filter(F.col(group_rank) <= k)
    )
    totals = histogram.groupBy("_range", score).agg(F.sum("_rows").alias("_rows"))
    ranges = totals.groupBy("_range").agg(F.sum("_rows").alias("_range_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranges.select("_range", F.coalesce(F.sum("_range_rows").over(before), F.lit(0)).alias("_above"))
    inside = totals.select("*", _rows_above("_rows", ["_range"], score).alias("_inside"))
    overall = _match(inside, offsets, ["_range"]).select(score, _rank_after(F.expr("_above + _inside"), overall_rank))
    # Stored, so that Spark knows its size and sends it to the wide rows if it is small.
    table = settle(_match(best, overall, [score]))[0]
    return _match(rows, table, [group, score])
