"""Compression of vectors to codes: each part of a vector becomes the number of its nearest codebook entry.

The codebooks are learned by Ball k-means over all vectors. The members of an entry lie in a ball
around it. An entry further from it than twice a member's distance cannot be nearer to that member,
so members near the middle (the stable core) keep their entry without a comparison, and the others
are compared with the entries of their ring only. Components are whole numbers, so that all
distances, sums and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import by_bytes, salted, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components are stored as whole parts of this.
SCALE = 256
#: Components up to this size have exact distances; vectors beyond it are refused.
LARGEST = 1 << 16
#: Bytes of vectors that are worked on at a time.
STEP_BYTES = 8 << 20
#: Vectors whose distances to all entries are held at a time.
STEP_ROWS = 8192

VECTORS = "id long, label string, whole array<int>, codes binary"
_VECTORS = pa.schema([("id", pa.int64()), ("label", pa.string()), ("whole", pa.list_(pa.int32())), ("codes", pa.binary())])


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``id, label, whole``: components as ``floor(scale * x)``, without vectors that are null or have
    null or non-finite components.
    """
    given = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    refused = F.raise_error(F.lit(f"vectors have components of less than {LARGEST}"))
    whole = F.transform("given", lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * scale)).otherwise(refused).cast("int"))
    finite = F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("string").alias("label"), given.alias("given"))
    return rows.filter(F.col("given").isNotNull() & finite).select("id", "label", whole.alias("whole"))


def first_entries(whole: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, position): the parts of the vectors of the smallest ids, nulls last.

    Ids alone are sorted first; the vectors up to the last of them are then a few rows.
    """
    ids = stored(whole.select("id").orderBy(F.col("id").asc_nulls_last()).limit(entries))
    last, known, n = ids.agg(F.max("id"), F.count("id"), F.count(F.lit(1))).first()
    near = whole.filter(F.col("id") <= last) if known else whole.filter("id is null")
    near = whole if known and n > known else near  # fewer ids than entries: vectors without an id come in
    few = stored(near.select("id", "whole").orderBy(F.col("id").asc_nulls_last(), "whole").limit(entries))
    rows = [r["whole"] for r in few.orderBy(F.col("id").asc_nulls_last(), "whole").collect()]
    if not rows:
        return np.zeros((parts, 0, 0), np.int64)
    if len({len(r) for r in rows}) > 1 or len(rows[0]) % parts:
        raise ValueError(f"vectors need one length that {parts} parts divide evenly")
    return np.array(rows, np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries; whole numbers below 2**53, so doubles are exact."""
    return (x * x).sum(1)[:, None] - 2.0 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def assign_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row (the lower of equals) and its squared distance, by comparing with all."""
    codes, away = np.empty(len(x), np.int64), np.empty(len(x))
    for a in range(0, len(x), STEP_ROWS):
        found = squared(x[a : a + STEP_ROWS], entries)
        codes[a : a + STEP_ROWS] = best = found.argmin(1)
        away[a : a + STEP_ROWS] = found[np.arange(len(best)), best]
    return codes, away


def assign_near(x: np.ndarray, entries: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from the entries that the rows had before, and the number of comparisons made.

    An entry whose squared distance from a row's own entry is more than four times the row's is
    further away than the own one. The entries within that bound, by distance, are the row's rings.
    """
    between = squared(entries, entries)
    near = np.argsort(between, axis=1, kind="stable")
    rings = np.take_along_axis(between, near, 1)
    own = x - entries[codes]
    away = (own * own).sum(1)
    reach = np.zeros(len(x), np.int64)
    order = np.argsort(codes, kind="stable")
    balls = np.split(order, np.searchsorted(codes[order], np.arange(1, len(entries))))
    for entry, members in enumerate(balls):
        if not len(members):
            continue
        bound = 4.0 * away[members]
        radius = bound.max()  # entries beyond it are no neighbours of this ball
        neighbours = np.searchsorted(rings[entry], radius, "right")
        reach[members] = np.searchsorted(rings[entry, :neighbours], bound, "right")
    moved, best, compared = codes.copy(), away.copy(), 0
    width = 2
    rest = np.flatnonzero(reach > 1)  # all others stay: only their own entry is within the bound
    while len(rest):
        now, rest = rest[reach[rest] <= width], rest[reach[rest] > width]
        for a in range(0, len(now), STEP_ROWS):
            rows = now[a : a + STEP_ROWS]
            candidates = near[codes[rows], : min(width, len(entries))]
            gap = x[rows][:, None, :] - entries[candidates]
            found = (gap * gap).sum(2)
            least = found.min(1)
            best[rows] = least
            moved[rows] = np.where(found == least[:, None], candidates, len(entries)).min(1)
            compared += candidates.size
        width *= 2
    return moved, best, compared


def _matrix(part: pa.Table, width: int) -> np.ndarray:
    column = part.column("whole").combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != width).any():
        raise ValueError(f"vectors need one length; {width} and {int(sizes[sizes != width][0])} were found")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), width)


def _old_codes(part: pa.Table, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)


def _assigner(books: np.ndarray, first: bool) -> Callable:
    parts, _, size = books.shape
    entries = books.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, STEP_BYTES):
            x = _matrix(part, parts * size)
            old = None if first else _old_codes(part, parts)
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x))
            for p in range(parts):
                rows = np.ascontiguousarray(x[:, p * size : (p + 1) * size])
                found = assign_all(rows, entries[p]) if first else assign_near(rows, entries[p], old[:, p])
                codes[:, p] = found[0]
                error += found[1]
            columns = [part.column("id"), part.column("label"), part.column("whole")]
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            done = pa.Table.from_arrays([*columns, packed, pa.array(error.astype(np.int64))], schema=_VECTORS.append(pa.field("error", pa.int64())))
            yield from done.combine_chunks().to_batches()

    return run


def assign(vectors: DataFrame, books: np.ndarray, first: bool) -> DataFrame:
    """New codes and errors of the vectors, stored. ``first`` compares with all entries; later rounds go on from the codes."""
    return stored(vectors.mapInArrow(_assigner(books, first), VECTORS + ", error long"))


def _summer(parts: int, entries: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for part in by_bytes(batches, STEP_BYTES):
            x, codes = _matrix(part, parts * size).astype(np.int64), _old_codes(part, parts)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, at = np.unique(codes[order, p], return_index=True)
                sums[p, used] += np.add.reduceat(x[order, p * size : (p + 1) * size], at, axis=0)
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        p, e, k = (a.ravel() for a in np.indices(sums.shape))
        used = counts[p, e] > 0
        arrays = [pa.array(a[used].astype(np.int32)) for a in (p, e, k)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums.ravel()[used]), pa.array(counts[p, e][used])], ["p", "e", "k", "total", "n"])

    return run


def moved_entries(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the rounded-down mean of its parts; an entry without any stays where it is.

    A task sends one row a component of the codebooks, and the driver gets as many.
    """
    parts, entries, size = books.shape
    rows = vectors.select("whole", "codes").mapInArrow(_summer(parts, entries, size), "p int, e int, k int, total long, n long")
    new = books.copy()
    for r in rows.groupBy("p", "e", "k").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[r["p"], r["e"], r["k"]] = r["total"] // r["n"]
    return new


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def learn_codes(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The rows of :func:`whole_vectors` with ``codes`` (one byte a part) and ``error``, and the codebooks.

    Each round reads the vectors with the codes of the round before and stores the new ones.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    whole = stored(vectors)
    books = first_entries(whole, parts, entries)
    if not books.size:
        return whole.select("*", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), books
    coded = whole.select("*", F.lit(None).cast("binary").alias("codes"))
    for k in range(rounds):
        coded = assign(coded.select("id", "label", "whole", "codes"), books, k == 0)
        books = moved_entries(coded, books)
    return assign(coded.select("id", "label", "whole", "codes"), books, rounds == 0), books


def compress(
    vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` of each usable vector.

    Vectors that are null or hold a null or non-finite component are left out. All others need one
    length that ``parts`` divides, and components of less than 65,536; anything else is an error that
    says so. Rows that repeat an id are vectors of their own; a null id comes after all others.
    Null is a label of its own. With fewer vectors than ``entries`` the codebooks have as many entries
    as there are vectors. An empty table gives an empty result. Only codebooks reach the driver.
    """
    coded, books = learn_codes(whole_vectors(vectors, id_col, vector_col, label_col), parts=parts, entries=entries, rounds=rounds)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = stored(sums).withColumnsRenamed({"label": "_label"})
    same: Callable[[DataFrame, DataFrame], Column] = lambda a, b: a["label"].eqNullSafe(b["_label"])
    rows = salted(coded.drop("whole"), sums, same, F.xxhash64("id", "codes"))
    return rows.select(
        F.col("id").alias(id_col), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )


def decode(codes: DataFrame, books: np.ndarray, output: str = "approximate") -> DataFrame:
    """The vectors that ``codes`` stand for, in the scale of the given ones, as ``output``."""
    parts, entries, size = books.shape
    flat_books = F.array(*[F.lit(float(v) / SCALE) for v in books.ravel().tolist()])
    pieces = [
        F.slice(flat_books, F.conv(F.hex(F.substring("codes", p + 1, 1)), 16, 10).cast("int") * size + (p * entries * size + 1), size)
        for p in range(parts)
    ]
    return codes.withColumn(output, F.concat(*pieces))
