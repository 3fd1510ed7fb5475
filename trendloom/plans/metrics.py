"""Counts that describe a run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def layer_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table, one job for all of them; a table that does not exist counts 0."""
    absent = [name for name, df in tables.items() if df is None]
    frames = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
        if df is not None
    ]
    if absent:
        frames.append(spark.createDataFrame([(name, 0) for name in absent], "table string, rows bigint"))
    return reduce(DataFrame.unionByName, frames)


def layer_digests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and content of each table, in one job: ``table, rows, digest``.

    The digest is the sum of 48 bits of the MD5 of each row, so neither the order of the rows nor that of
    the columns matters, and repeated rows count. Real numbers count to six digits.
    """
    frames = []
    for name, df in tables.items():
        row = F.concat_ws("\x1f", *[_as_text(df.schema[c]) for c in sorted(df.columns)])
        bits = F.conv(F.substring(F.md5(row), 1, 12), 16, 10).cast("decimal(38,0)")
        frames.append(df.agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest")
        ).select(F.lit(name).alias("table"), "rows", "digest"))
    return reduce(DataFrame.unionByName, frames)


def _as_text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = F.rint(value * 1000000.0).cast("long")
    elif isinstance(field.dataType, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(field.dataType, T.ArrayType):
        value = F.concat(F.lit("["), F.array_join(value, "|"), F.lit("]"))
    return F.coalesce(value.cast("string"), F.lit("~"))


def sentiment_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def enrichment_errors(enriched: DataFrame) -> DataFrame:
    """Rows, rows with an error, and their share in percent (null for an empty table)."""
    counted = enriched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("enrichment_error").alias("errors"),
    )
    share = F.try_divide(F.col("errors") * 100.0, F.col("total"))
    return counted.withColumn("error_pct", F.round(share, 1))


def rows_without_id(mapped: DataFrame) -> DataFrame:
    """Mapped Silver rows that have no id and are therefore left out of the table."""
    return mapped.agg(F.count_if(F.col("unified_id").isNull()).alias("rows"))
