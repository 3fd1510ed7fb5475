"""Connected components of a links table, by alternating star steps; nothing leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators.settle import settle

MAX_STEPS = 100


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the least of its neighbourhood."""
    both = links.union(links.select("v", "u")).distinct()
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``(u, v)`` links but the least of each component.

    Null ends and links of a node with itself are left out. Each step is stored; the steps end when
    one changes nothing, which takes about the logarithm of the longest chain.
    """
    clean = links.select("u", "v").filter("u != v")
    stars, count = settle(_small(clean))
    state = None
    for _ in range(MAX_STEPS):
        if not count:
            break
        new = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == state:
            break
        state = new
        stars, count = settle(_small(_large(stars)))
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
