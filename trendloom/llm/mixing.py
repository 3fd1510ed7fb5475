"""Mixing sources to target weights by thresholds on a hash of the document.

Sizes are summed by source and hash bucket. The bucket in which a source reaches its budget is the
only one that is looked into again, in finer buckets, until one hash is left in it. Documents below
the threshold get a copy more than those above, so nothing is sorted by document. A larger budget
has larger thresholds on the same hashes: mixes of growing budgets are nested.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.shared import free_name, salted, stored
from trendloom.operators.numbering import number_rows
from trendloom.operators.settle import settle

#: Words are runs of other characters than space and the characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a hash, and how many of them one level of buckets tells apart.
HASH_BITS, LEVEL_BITS = 60, 10
#: A source gives at most so many times its size.
MOST_REPEATS = 3
SEED = "mix"


def document_hash(docs: DataFrame, id_col: str, text_col: str, seed: str = SEED) -> Column:
    """60 bits of a digest of the id, so that reruns agree. A document without an id goes by its text."""
    name = F.coalesce(docs[id_col].cast("string"), F.sha2(docs[text_col].cast("string"), 256), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED
) -> DataFrame:
    """``id, source, size, hash`` of each document, stored: later steps read no texts."""
    return stored(docs.select(
        docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        document_hash(docs, id_col, text_col, seed).alias("hash"),
    ))


def cycled_weights(sources: DataFrame, cycle: Sequence[int] = (5, 2, 1)) -> DataFrame:
    """``source, weight``: the weights of ``cycle`` in turn, sources by code point, null last."""
    named = sources.select("source").distinct().withColumn("_none", F.col("source").isNull())
    placed = number_rows(named, "_none", [F.col("source")], "at")
    weights = F.array(*[F.lit(w) for w in cycle])
    return placed.select("source", F.get(weights, (F.col("at") % len(cycle)).cast("int")).alias("weight"))


def _same_source(left: DataFrame, right: DataFrame, *more: str) -> Column:
    """Both frames have the columns; null is a source of its own."""
    return reduce(lambda a, b: a & b, [left["source"].eqNullSafe(right["source"]), *[left[c] == right[c] for c in more]])


def _level(sources: DataFrame, budget: int, weight: int | float, most: int) -> tuple[int, int | float]:
    """Words and weight that are left once the sources that stop at ``most`` times their size have theirs.

    Each round is one sum over the sources; it stops at least one source more, or is the last.
    """
    left, rest = budget, weight
    while True:
        full = _share(left, rest) > F.col("source_size") * most
        taken = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        after = budget - taken["words"], weight - taken["weight"]
        if after == (left, rest):
            return after
        left, rest = after


def _share(left: int, rest: int | float) -> Column:
    """A source's part by weight; once no weight is left, all sources that weigh anything are full.

    Weights may be 32-bit integers, and words that fit into 32 bits would be multiplied as such.
    """
    if not rest:
        return F.when(F.col("weight") > 0, F.lit(float("inf"))).otherwise(0.0)
    return (F.col("weight") * F.lit(left).cast("long")).cast("double") / F.lit(rest).cast("double")


def find_targets(
    sources: DataFrame, budgets: Sequence[float] = (1.0,), most: int = MOST_REPEATS
) -> DataFrame:
    """``budget, source, source_size, target`` from ``source, source_size, weight``.

    A budget is a share of all sizes. It is dealt by weight; a source stops at ``most`` times its
    size, and what it leaves is dealt again, until no source is above.
    """
    total, weight = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    dealt = []
    for budget in budgets:
        left, rest = _level(sources, int(budget * total), weight, most)
        share, full = _share(left, rest), (F.col("source_size") * most).cast("double")
        dealt.append(sources.select(
            F.lit(float(budget)).alias("budget"), "source", "source_size", F.least(share, full).alias("target")
        ))
    return stored(reduce(DataFrame.unionAll, dealt))


def _buckets(sizes: DataFrame, level: int) -> DataFrame:
    """Sizes by source and bucket of a level; rows are summed up in each task before they move."""
    bucket = F.shiftright("hash", HASH_BITS - LEVEL_BITS * level)
    return sizes.groupBy("source", bucket.alias("bucket")).agg(
        F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
    )


def _crossed(buckets: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each row of ``wanted`` the bucket in which its source reaches ``need``, with what is still
    needed from that bucket. A window has at most one level of buckets of one source.
    """
    joined = buckets.withColumn("parent", F.shiftright("bucket", LEVEL_BITS))
    wanted = wanted.withColumnsRenamed({"bucket": "parent"})
    rows = joined.join(wanted, _same_source(joined, wanted, "parent")).drop(wanted["source"], wanted["parent"])
    order = Window.partitionBy("budget", "source").orderBy("bucket")
    above = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("above", above)
        .filter("above < need and need <= above + words")
        .select("budget", "source", "bucket", (F.col("need") - F.col("above")).alias("need"), "words", "low", "high")
    )


def find_thresholds(
    sizes: DataFrame, weights: DataFrame | None = None, budgets: Sequence[float] = (1.0,), most: int = MOST_REPEATS
) -> DataFrame:
    """``budget, source, source_size, target, whole, threshold`` for :func:`measure`'s rows.

    Each document of a source is taken ``whole`` times, and once more if its hash is below the
    threshold. ``weights`` holds ``source, weight``; a source that it does not name weighs nothing,
    and without it :func:`cycled_weights` holds. The document at the threshold is taken if the target
    is then nearer (or as near), so a source misses its target by half of one document at most.
    """
    first = stored(_buckets(sizes, 1))
    known = stored(first.groupBy("source").agg(F.sum("words").alias("source_size")))
    weights = cycled_weights(known) if weights is None else weights.select("source", "weight")
    weighed = known.join(weights, _same_source(known, weights), "left").select(
        known["source"], "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
    )
    targets = find_targets(stored(weighed), budgets, most)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    targets = targets.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))

    wanted = targets.filter("need > 0").select("budget", "source", "need", F.lit(0).cast("long").alias("bucket"))
    buckets, found = first, []
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        crossed, _ = settle(_crossed(buckets, wanted))
        found.append(crossed.filter("low = high"))
        wanted, n = settle(crossed.filter("low < high").select("budget", "source", "need", "bucket"))
        if not n:
            break
        # Only the documents of these buckets are read again, and fewer at each level.
        edges = wanted.select(F.col("source"), F.col("bucket").alias("edge")).distinct()
        rows = sizes.withColumn("edge", F.shiftright("hash", HASH_BITS - LEVEL_BITS * level))
        sizes = stored(rows.join(edges, _same_source(rows, edges, "edge"), "left_semi").drop("edge"))
        buckets = _buckets(sizes, level + 1)
    at = reduce(DataFrame.unionAll, found).select(
        "budget", "source", (F.col("low") + (F.col("need") * 2 >= F.col("words")).cast("long")).alias("threshold")
    )
    return stored(targets.join(at, _same_source(targets, at, "budget"), "left").select(
        targets["budget"], targets["source"], "source_size", "target", "whole",
        F.coalesce("threshold", F.lit(0)).alias("threshold"),
    ))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, budgets: Sequence[float] = (1.0,), *,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST_REPEATS, seed: str = SEED,
) -> DataFrame:
    """For each budget and row of ``docs``: ``budget, id_col, size, source_size, target, copies, taken``.

    ``size`` is the number of words, ``target`` the words its source shall give, ``taken`` those that
    this document gives, repeats counted. Null and empty texts have no words; they are listed, and
    their copies count nothing. Null is a source of its own. Rows that repeat an id have one hash
    and are taken alike; rows without an id go by their text. A table without any word has targets of
    0. Helper columns are renamed copies, so other columns of ``docs`` cannot clash.
    """
    sizes = measure(docs, id_col, text_col, source_col, seed)
    limits = find_thresholds(sizes, weights, budgets, most)
    rows = _counted(sizes, limits, "hash", "source", "copies")
    return rows.select(
        "budget", F.col("id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _counted(rows: DataFrame, limits: DataFrame, hash_col: str, source_col: str, copies: str) -> DataFrame:
    """Add the limits of a row's source and its copies. Rows of a hot source meet copies of its limits."""
    named = limits.withColumnsRenamed({"source": "_limit_source"})
    joined = salted(
        rows, named, lambda a, b: a[source_col].cast("string").eqNullSafe(b["_limit_source"]), F.col(hash_col)
    )
    return joined.drop("_limit_source").withColumn(
        copies, F.col("whole") + (F.col(hash_col) < F.col("threshold")).cast("long")
    )


def repeat_documents(
    docs: DataFrame, limits: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as ``limits`` (of one budget) says, with their columns."""
    kept = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    key, source = free_name(docs, "_hash"), free_name(docs, "_source")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"),
        document_hash(docs, id_col, text_col, seed).alias(key), docs[source_col].cast("string").alias(source),
    )
    counted = _counted(rows, limits, key, source, "_copies")
    return counted.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*kept)
