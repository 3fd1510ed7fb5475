"""Resampling documents towards a target by the importance of hashed word runs.

Features are runs of words, hashed by CRC-32 into buckets. A document's weight is the sum of the log
ratios of its features' buckets, target against corpus; Gumbel noise on top makes the highest scores
a draw without replacement. Checksums are worked out for the distinct features of a batch: those of
equal length are the rows of a byte matrix, and one step updates the checksums of a whole column.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.hashing import flat
from trendloom.llm.shared import LOWER, by_bytes, small_batches, stored
from trendloom.operators.numbering import number_rows

BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Scores are whole numbers of this part of a natural logarithm.
SCALE = 1000
#: Bytes of text that are taken apart at a time.
STEP_BYTES = 4 << 20
#: Bytes of features that are copied together at a time; each takes 16 bytes of memory meanwhile.
GATHER_BYTES = 1 << 20
#: Features longer than this are checksummed one by one, because a column of a matrix would hold a few only.
LONGEST_COLUMN = 256
#: Reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

_LOWER = np.frombuffer(LOWER, np.uint8)
#: Bytes that belong to words once A-Z are lower-cased: digits, a-z, and all of non-ASCII characters.
_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True

FEATURES = "id long, n_words long, buckets binary"
_FEATURES = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())])


def crc_table() -> np.ndarray:
    """Effect of each byte on a checksum: eight steps of the shift register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


def crc_matrix(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a byte matrix, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in rows.T:
        crc = (crc >> np.uint32(8)) ^ table[(crc ^ column) & np.uint32(255)]
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of slices of ``data``: those of one length are one matrix, and the sums go back to their places."""
    crc = np.zeros(len(starts), np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, first = np.unique(sizes[order], return_index=True)
    for length, at in zip(lengths.tolist(), np.split(order, first[1:])):
        if length > LONGEST_COLUMN:
            crc[at] = [zlib.crc32(data[s : s + length].tobytes()) for s in starts[at].tolist()]
        else:
            crc[at] = crc_matrix(data[starts[at][:, None] + np.arange(length)], table)
    return crc


def feature_buckets(texts: pa.Array, n: int, buckets: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the features of all texts, features before each text (and in all), and words of each text.

    The features of a text are its runs of 1 to ``n`` words, shorter runs first.
    """
    raw, offsets = flat(texts)
    # One separator behind each text, so that a word ends where its text does.
    spaced = np.insert(_LOWER[raw], offsets[1:], 32)
    inside = np.zeros(len(spaced) + 2, np.int8)
    inside[1:-1] = _WORD[spaced]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    words = np.diff(np.searchsorted(starts, offsets + np.arange(len(offsets))))
    if not len(starts):
        return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64), words
    # Words one after another with one space behind each; a run of words is a slice without its last space.
    kept = inside[1:-1].astype(bool)
    spaced[~kept] = 32
    kept[ends] = True
    line = spaced[kept]
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    owner = np.repeat(np.arange(len(words)), words)
    runs = []
    for k in range(1, n + 1):
        first = np.arange(len(starts) - k + 1)
        first = first[owner[first] == owner[first + k - 1]]
        runs.append((owner[first], at[first], at[first + k] - 1 - at[first]))
    owner, begin, size = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(owner, kind="stable")
    found = _distinct_buckets(line, begin[order], size[order], buckets, table)
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]), words


def _distinct_buckets(line: np.ndarray, begin: np.ndarray, size: np.ndarray, buckets: int, table: np.ndarray) -> np.ndarray:
    """Bucket of each slice; a slice that occurs often is checksummed once."""
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = np.empty(bounds[-1], np.uint8)
    cuts = np.unique(np.append(np.searchsorted(bounds, np.arange(0, bounds[-1], GATHER_BYTES)), len(size)))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        data[bounds[a] : bounds[b]] = line[np.arange(bounds[a], bounds[b]) + np.repeat(begin[a:b] - bounds[a:b], size[a:b])]
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = values.dictionary_encode()
    known, offsets = flat(coded.dictionary)
    crc = crc_of(known, offsets[:-1], np.diff(offsets), table)
    return (crc % np.uint32(buckets)).astype(np.uint16)[coded.indices.to_numpy()]


def _reader(n: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = crc_table()
        for part in by_bytes(batches, STEP_BYTES):
            found, before, words = feature_buckets(part.column("text").combine_chunks(), n, buckets, table)
            packed = [found[a:b].tobytes() for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("id").combine_chunks(), pa.array(words, pa.int64()), pa.array(packed, pa.binary())], schema=_FEATURES)

    return run


def hash_features(docs: DataFrame, id_col: str, text_col: str, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``id, n_words, buckets`` of each document, stored; the buckets take two bytes a feature.

    Words are runs of other characters than ASCII ones that are no digits or letters; A-Z are
    lower-cased. Null texts have none.
    """
    if not 0 < buckets <= 1 << 16 or n < 1:
        raise ValueError("there are 1 to 65,536 buckets, and runs of at least one word")
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return stored(rows.mapInArrow(_reader(n, buckets), FEATURES))


def _counter(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            counts += np.bincount(flat(batch.column("buckets"))[0].view(np.uint16), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["bucket", "n"])

    return run


def count_buckets(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of each bucket: a task sends one row a bucket, the driver gets one row a bucket."""
    rows = features.select("buckets").mapInArrow(_counter(buckets), "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(target: np.ndarray, corpus: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * ln(target share / corpus share))`` of each bucket, with one feature more in each."""
    more_target, more_corpus = float(target.sum() + len(target)), float(corpus.sum() + len(corpus))
    gains = [
        math.floor(scale * math.log((t + 1.0) * more_corpus / ((s + 1.0) * more_target)))
        for t, s in zip(target.tolist(), corpus.tolist())
    ]
    return np.array(gains, np.int64)


def _weigher(gains: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("buckets"))
            at = offsets // 2
            sums = np.concatenate([[0], np.cumsum(gains[data.view(np.uint16)])])
            arrays = [batch.column("id"), batch.column("n_words"), pa.array(np.diff(at), pa.int64()), pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_features", "weight"])

    return run


def gumbel(id_col: Column, seed: int | str, scale: int = SCALE) -> Column:
    """Noise of a document: 32 bits of a digest of its id as a Gumbel number, in whole parts of ``scale``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((bits.cast("double") + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = 10, n: int = 1, buckets: int = BUCKETS, seed: int | str = 2024,
    least_words: int = LEAST_WORDS, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
) -> DataFrame:
    """For each row of ``docs``: ``id_col, n_features, weight, score, rank``, ranks for the drawn ones.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are
    drawn, those of the highest scores; ties go to the smaller id. Null and empty texts have no
    feature and the weight 0; they count in nothing and are never drawn unless ``least_words`` is 0.
    Rows that repeat an id are documents of their own with the same noise. A document without an id
    has the noise of the name ``null`` and stands behind its ties. Of an empty target each bucket has the same share.
    Tables of ``buckets`` numbers are all that the driver and the tasks hold of the corpus.
    """
    features = hash_features(docs, id_col, text_col, n, buckets)
    wanted = hash_features(target.select(F.lit(None).cast("long").alias("id"), target[target_text_col].alias("text")), "id", "text", n, buckets)
    gains = bucket_gains(count_buckets(wanted, buckets), count_buckets(features, buckets), scale)
    weighed = features.mapInArrow(_weigher(gains), "id long, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed, scale)))
    drawn = percent * scored.filter(F.col("n_words") >= least_words).count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = number_rows(scored.withColumn("short", F.col("n_words") < least_words), "short", order, "at")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1).cast("long")
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))


def keep_drawn(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, with their columns. Rows that repeat a drawn id all stay."""
    drawn = resample(docs, target, id_col=id_col, **options).filter("rank is not null").select(F.col(id_col).alias("_drawn")).distinct()
    return docs.join(drawn, docs[id_col].cast("long").eqNullSafe(drawn["_drawn"]), "left_semi")
