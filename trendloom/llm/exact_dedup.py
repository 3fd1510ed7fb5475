"""Exact dedup against a history: a minimal perfect hash over the history's distinct digests.

The index is cut into shards by a hash of the digest. Each shard holds level bitmaps (every key
owns one bit, the number of bits before it is its slot) and slots with the full digest, the winner
and the group's size. A lookup compares the whole digest with the slot's, so a text that the
history has not seen is never taken for one that it has.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import free_name, mix, mix_int, stored
from trendloom.operators.settle import settle

#: Digests of one shard, about; a shard is what one task holds in memory.
SHARD_KEYS = 100_000
#: Bits per key of each level, and levels before a key is kept in the list of the rest.
GAMMA, LEVELS = 2, 40

INDEX = "shard int, sizes binary, bits binary, digests binary, winners binary, known binary, counts binary"
GROUPS = "digest binary, keep_id long, group_size long"
_INDEX = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("sizes", "bits", "digests", "winners", "known", "counts")]])
_GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def normalised(text: Column) -> Column:
    """Each run of white space (space and the characters 9 to 13) as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(mix_int(level + 1))) % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits, and the slot of each key: 0 to n - 1, each once.

    A key owns the first bit that no other remaining key falls on. Keys that no level parts (equal
    64-bit keys) get the last slots.
    """
    left, sizes, bits = np.arange(len(keys)), [], []
    owned = np.full(len(keys), -1, np.int64)
    base = 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, GAMMA * len(left))
        at = _place(keys[left], level, size)
        alone = np.bincount(at, minlength=size)[at] == 1
        flags = np.zeros(size, bool)
        flags[at[alone]] = True
        owned[left[alone]] = base + at[alone]
        sizes.append(size)
        bits.append(flags)
        base += size
        left = left[~alone]
    all_bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    before = np.cumsum(all_bits) - all_bits
    slots = np.empty(len(keys), np.int64)
    set_ = owned >= 0
    slots[set_] = before[owned[set_]]
    slots[~set_] = set_.sum() + np.arange((~set_).sum())
    return sizes, all_bits, slots


def find_slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot that each key would own, -1 where no level has a bit for it."""
    before = np.cumsum(bits) - bits
    slots, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + _place(keys[left], level, size)
        hit = bits[at]
        slots[left[hit]] = before[at[hit]]
        left, base = left[~hit], base + size
    return slots


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "S32") if len(column) else np.zeros(0, "S32")


def _rows(digests: np.ndarray) -> np.ndarray:
    return np.frombuffer(digests.tobytes(), np.uint8).reshape(-1, 32)


def _keys(digests: np.ndarray) -> np.ndarray:
    return _rows(digests)[:, :8].copy().view(np.uint64).ravel()


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    digests = _digests(rows.column("digest"))
    sizes, bits, slots = build_hash(_keys(digests))
    order = np.argsort(slots)
    known = rows.column("first").is_valid().to_numpy().astype(np.uint8)[order]
    first = rows.column("first").fill_null(0).to_numpy()[order]
    counts = rows.column("n").to_numpy()[order]
    parts = [np.array(sizes, np.int64), np.packbits(bits), _rows(digests)[order], first, known, counts]
    return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], schema=_INDEX)


def _look_up(key: tuple, index: pa.Table, seen: pa.Table) -> pa.Table:
    digests = _digests(seen.column("digest"))
    slots = np.full(len(digests), -1, np.int64)
    n = 0
    if len(index):
        part = {c: index.column(c)[0].as_py() for c in index.column_names[1:]}
        sizes = np.frombuffer(part["sizes"], np.int64).tolist()
        bits = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=sum(sizes)).astype(bool)
        held = np.frombuffer(part["digests"], np.uint8).reshape(-1, 32)
        n = len(held)
        slots = find_slots(_keys(digests), sizes, bits)
        own = int(bits.sum())
        if own < n and len(digests):  # keys of equal first 64 bits stand in a list
            rest = {held[k].tobytes(): k for k in range(own, n)}
            slots = np.array([rest.get(d, s) for d, s in zip(map(bytes, _rows(digests)), slots.tolist())])
        same = slots >= 0
        same[same] = (held[slots[same]] == _rows(digests)[same]).all(axis=1)
        slots = np.where(same, slots, -1)
    new = pa.array(slots < 0)
    extra = seen.column("n").to_numpy()
    nonmembers = seen.filter(new)
    out = [pa.Table.from_arrays([nonmembers.column(c) for c in ("digest", "first", "n")], schema=_GROUPS)]
    if n:
        counts = np.frombuffer(part["counts"], np.int64).copy()
        counts[slots[slots >= 0]] += extra[slots >= 0]
        known = np.frombuffer(part["known"], np.uint8) == 0
        winners = pa.array(np.frombuffer(part["winners"], np.int64), mask=known)
        out.append(pa.Table.from_arrays([pa.array([h.tobytes() for h in held], pa.binary()), winners, pa.array(counts)], schema=_GROUPS))
    return pa.concat_tables(out)


def _shard(count: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(count)).cast("int")


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """Index rows from history groups ``(digest, first, n)``; one row per shard, in the shared folder."""
    keyed = groups.withColumn("shard", _shard(shards))
    return stored(keyed.groupBy("shard").applyInArrow(_build, INDEX))


def exact_dedup(docs: DataFrame, history: Column, *, id_col: str = "doc_id", text_col: str = "text", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    ``history`` tells the rows already accepted. The winner of a text is the smallest id of its
    history rows, or else of its new ones; the others are repeats. Null text counts as empty. Rows
    that repeat an id are one document and stay or go together; a null id wins only where its group
    has no other. Copies meet as counts: rows are summed up per digest within each task, so
    thousands of copies reach a shard as one row per task.
    """
    keyed, _ = settle(docs.select(
        F.col(id_col).cast("long").alias("__id"), F.coalesce(history, F.lit(False)).alias("__old"),
        F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
    ))
    grouped = lambda rows: rows.groupBy("digest").agg(F.min("__id").alias("first"), F.count(F.lit(1)).alias("n"))
    old, n_old = settle(grouped(keyed.filter("__old")))
    new, n_new = settle(grouped(keyed.filter("not __old")))
    shards = max(1, math.ceil(max(n_old, n_new) / shard_keys))
    index = build_index(old, shards)
    found = index.groupBy("shard").cogroup(new.withColumn("shard", _shard(shards)).groupBy("shard")).applyInArrow(_look_up, GROUPS)
    found = stored(found)
    return keyed.join(found, "digest").select(
        F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def early_half(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The older half of the ids as history: every id up to the middle of their range."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    return F.col(id_col) <= F.lit(None if low is None else (low + high) // 2)


def drop_repeats(docs: DataFrame, history: Column, **options) -> DataFrame:
    """The rows of ``docs`` that win their group, with their columns.

    Only ids travel: losers are taken out by an anti join on the id.
    """
    id_col = options.get("id_col", "doc_id")
    lost = exact_dedup(docs, history, **options).filter("not kept")
    lost = lost.select(F.col(id_col).alias(free_name(docs, "lost"))).distinct()
    return docs.join(lost, docs[id_col].eqNullSafe(lost[lost.columns[0]]), "left_anti")
