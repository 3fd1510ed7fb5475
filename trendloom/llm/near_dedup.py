"""Near-duplicate groups by min-max hashing, with links confirmed on full shingle sets.

Each permutation gives two signature values, its minimum and its maximum, so 64 permutations give
128 values. Four values make a band; documents that share a band's values are candidates. Equal sets
are collapsed first. Candidates are then met in two passes that need no list of all pairs:

1. each bucket links its members to its least member; confirmed links give components;
2. where a bucket still holds several components, its members are compared in blocks: pairs of
   different components by their signatures, and those with a fair estimate by their sets. A block
   gives back only the links that join its components, never more than it has members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.components import components
from trendloom.llm.hashing import Powers, chained, word_hashes
from trendloom.llm.shared import by_bytes, free_name, mix, mix_int, small_batches, stored

SHINGLE, SIMILARITY = 5, 75
BANDS, PERMUTATIONS_PER_BAND = 32, 2
#: Share of equal signature values from which a pair is confirmed on its sets. Two sets of
#: similarity 0.75 agree in 96 of 128 values on average, with a deviation of 5.
ESTIMATE = 0.55
#: Members of one block of a bucket in the second pass.
BLOCK = 512
HASH_BYTES = 4 << 20

_SIGNED = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("keys", pa.list_(pa.int64())), ("sig", pa.binary())])
SIGNED = "id long, n long, d1 long, d2 long, keys array<long>, sig binary"


def shingle_sets(texts: pa.Array, powers: Powers, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, in order; a shorter text is one shingle, an empty one has none."""
    hashes, offsets = word_hashes(texts, powers)
    rolled = hashes
    for k in range(1, size):
        rolled = chained(rolled[:-1], hashes[k:]) if len(rolled) > 0 else rolled
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = hashes[a : a + 1]
            for k in range(a + 1, b):
                whole = chained(whole, hashes[k : k + 1])
            out.append(mix(whole ^ np.uint64(b - a)))
        else:
            out.append(hashes[:0])
    return out


def permutations(count: int) -> list[tuple[np.uint64, np.uint64]]:
    return [(np.uint64(mix_int(2 * k + 1) | 1), np.uint64(mix_int(2 * k + 2))) for k in range(count)]


def signature(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Minimum and maximum of each non-empty set under each permutation; one row per set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * count), np.uint64)
    for k, (a, b) in enumerate(permutations(count)):
        values = flat * a + b
        values ^= values >> np.uint64(29)
        out[:, 2 * k] = np.minimum.reduceat(values, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(values, starts)
    return out


def _signer(size: int, bands: int, per_band: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in by_bytes(batches, HASH_BYTES):
            ids = part.column("id").combine_chunks()
            sets = shingle_sets(part.column("__text").combine_chunks(), powers, size)
            full = [k for k, s in enumerate(sets) if len(s)]
            one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            keys: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            if full:
                held = [sets[k] for k in full]
                values = signature(held, bands * per_band)
                band = values.reshape(len(full), bands, 2 * per_band)
                key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(full), bands))
                for k in range(2 * per_band):
                    key = chained(key, band[:, :, k])
                key = np.ascontiguousarray(key).view(np.int64)
                short = np.ascontiguousarray((values & np.uint64(0xFFFF)).astype("<u2"))
                for row, k in enumerate(full):
                    one[k], two[k] = held[row].sum(), np.bitwise_xor.reduce(mix(held[row] + np.uint64(7)))
                    keys[k], sigs[k] = key[row], short[row].tobytes()
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary()),
            ], schema=_SIGNED)

    return run


def _setter(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in by_bytes(batches, HASH_BYTES):
            sets = shingle_sets(part.column("__text").combine_chunks(), powers, size)
            lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("id").combine_chunks(), lists], names=["id", "shingles"])

    return run


def _linking(values: int, estimate: float, similarity: int) -> Callable:
    """Links between components that meet in a bucket, as few as join them.

    Pairs with a fair estimate come surest first. A pair is confirmed on the full sets, unless the
    links so far join it, and only in the first of the buckets that it shares.
    """
    least = int(values * estimate)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, left_no, right_no = (k.as_py() for k in key)
        rows = rows.combine_chunks()
        ids, block = rows.column("id").to_numpy(), rows.column("block").to_numpy()
        root = {c: c for c in rows.column("comp").to_pylist()}
        comps, sizes = rows.column("comp").to_numpy(), rows.column("n").to_numpy()
        sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), "<u2").reshape(len(rows), values)
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        lists = rows.column("shingles").combine_chunks()
        cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        flat = lists.flatten().to_numpy()

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        left, right = np.flatnonzero(block == left_no), np.flatnonzero(block == right_no)
        found = []
        for k in left.tolist():
            others = right[(comps[right] != comps[k]) & ((right > k) | (left_no != right_no))]
            others = others[100 * np.minimum(sizes[others], sizes[k]) >= similarity * np.maximum(sizes[others], sizes[k])]
            agree = (sigs[others] == sigs[k]).sum(axis=1)
            others, agree = others[agree >= least], agree[agree >= least]
            shared = keys[others] == keys[k]
            first = keys[k][np.argmax(shared, axis=1)] == bucket
            found.append(np.stack([np.full(int(first.sum()), k), others[first], agree[first]]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        links = []
        for a, b in pairs[:2, np.argsort(-pairs[2], kind="stable")].T.tolist():
            one, two = top(int(comps[a])), top(int(comps[b]))
            if one == two:
                continue
            both = len(np.intersect1d(flat[cuts[a] : cuts[a + 1]], flat[cuts[b] : cuts[b + 1]], assume_unique=True))
            if 100 * both >= similarity * (sizes[a] + sizes[b] - both):
                root[max(one, two)] = min(one, two)
                links.append((ids[a], ids[b]))
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    two = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(one, "u").join(two, "v")
    return joined.filter(100 * both >= similarity * (F.size("a") + F.size("b") - both)).select("u", "v")


def near_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: int = SIMILARITY,
    bands: int = BANDS, per_band: int = PERMUTATIONS_PER_BAND,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for each row of ``docs``.

    Null and empty texts, and texts of white space only, have no shingles and are linked with
    nothing. A row with a null id is linked with nothing and kept. Rows that repeat an id are one
    document. Only id and text are read, so other columns never clash. Two sets of similarity 0.75
    share no band with a probability of 5 in a million, more similar ones less often.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    signed = stored(texts.mapInArrow(_signer(size, bands, per_band), SIGNED))
    full = signed.filter("n > 0 and id is not null")
    classes = stored(full.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")))
    members = full.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    met = members.select("id", F.explode("keys").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    buckets = stored(met.join(shared.select("bucket", "least"), "bucket"))
    met_ids = stored(buckets.select("id").distinct())
    sets = stored(texts.join(met_ids, "id", "left_semi").mapInArrow(_setter(size), "id long, shingles array<long>"))
    widths = members.select("id", "n")
    stars = buckets.filter("id != least").select(F.col("least").alias("u"), F.col("id").alias("v")).distinct()
    fair = stars.join(widths.select(F.col("id").alias("u"), F.col("n").alias("nu")), "u").join(
        widths.select(F.col("id").alias("v"), F.col("n").alias("nv")), "v"
    ).filter(f"100 * least(nu, nv) >= {similarity} * greatest(nu, nv)").select("u", "v")
    links = stored(confirmed(fair, sets, similarity))
    links = links.union(_second_pass(buckets, members, sets, components(links), similarity, 2 * bands * per_band))
    merged = components(links)
    labelled = classes.join(merged, classes["rep"] == merged["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("comp")
    )
    rows = signed.select("id", "n", "d1", "d2")
    linked = rows.filter("n > 0 and id is not null").join(labelled, ["n", "d1", "d2"]).select("id", "n", "comp")
    alone = rows.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("comp"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
        F.col("id").eqNullSafe(F.col("comp")).alias("kept"),
    )


def _second_pass(buckets: DataFrame, members: DataFrame, sets: DataFrame, merged: DataFrame, similarity: int, values: int) -> DataFrame:
    """Links between members of a bucket that the first pass left in different components."""
    placed = buckets.select("bucket", "id").join(merged, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("comp")
    )
    open_ = placed.groupBy("bucket").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("met")
    ).filter("low < high")
    mixed = stored(placed.join(open_.select("bucket", "met"), "bucket"))
    # Blocks of a large bucket meet in pairs; a member goes to each pair of its block.
    blocks = F.ceil(F.col("met") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j"))))
    spread = mixed.select("bucket", "id", "comp", own.alias("block"), pair.alias("p")).select(
        "bucket", "id", "comp", "block", F.col("p.i").alias("i"), F.col("p.j").alias("j")
    )
    held = members.select("id", "n", "sig", "keys").join(sets, "id").dropDuplicates(["id"])
    return stored(spread.join(held, "id").groupBy("bucket", "i", "j").applyInArrow(
        _linking(values, ESTIMATE, similarity), "u long, v long"
    ))


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group, with all columns of ``docs``; only ids of the others travel."""
    lost = near_groups(docs, id_col=id_col, **options).filter("not kept").select(F.col(id_col).alias(free_name(docs, "lost")))
    return docs.join(lost, docs[id_col] == lost[lost.columns[0]], "left_anti")
