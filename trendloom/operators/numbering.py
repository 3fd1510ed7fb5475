"""Consecutive numbers over a sorted table, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.ranking import in_ranges


def number_rows(df: DataFrame, group: str, within: Sequence[Column], name: str) -> DataFrame:
    """Number rows from 0 in the order of ``group`` (nulls first), then ``within``.

    Rows are stored in even ranges of that order, so many rows of one group are many ranges. Places
    are counted inside a range and shifted by the sizes of the ranges before it; only one row per
    range passes through the shared window. Ties of the whole order get consecutive numbers.
    """
    order = [F.col(group).asc_nulls_first(), *within]
    ranged = in_ranges(df, order)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    placed = ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return placed.join(shifts, "_range").withColumn(name, F.col("_shift") + F.col("_place") - 1).drop(
        "_range", "_shift", "_place"
    )
