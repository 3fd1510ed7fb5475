"""Language model in a log-frequency Bloom filter.

The filter holds, for each n-gram and each context, its count on a logarithmic scale: a count of
level q is entered q times, as (key, 1) to (key, q). A lookup probes level after level until one is
absent, so errors are one-sided and rarely more than one level. Probabilities of the orders are
smoothed into each other, down to exact unigram counts.

Counting is one pass. Each task sums up the n-grams of its texts and sends each segment of the model
one packed row; a segment adds up what it got and becomes sorted words with counts, or a piece of
the filter. Scoring goes the same way back: texts are packed into shards, a shard sends each segment
the distinct keys it has there, the segment looks them up, and the answers meet their shard again.
Each text is read three times and each key travels once per shard, at any size of the model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.hashing import Powers, chained, word_hashes
from trendloom.llm.shared import by_bytes, free_name, mix, mix_int, small_batches, stored

ORDER = 2
#: Weight of the lower order, in counts.
PSEUDO = 2.0
#: Bits and hash functions of the filter for each entry.
BITS, HASHES = 10, 5
#: Bytes of text behind one segment, and texts that a task counts before it sends.
SEGMENT_BYTES, COUNT_BYTES = 2 << 20, 8 << 20
#: Bytes of model in one slice, a run of segments, at most as estimated from the text.
SLICE_BYTES = 256 << 20
#: Bytes of text in one shard, and bytes of texts whose keys may meet in one segment, if the model's are fewer.
SHARD_BYTES, MEET_BYTES = 4 << 20, 64 << 20

#: Level of zstd for the texts of a shard, which are stored once and shuffled once.
PACK_LEVEL = 6

END, START = np.uint64(mix_int(101)), np.uint64(mix_int(102))
CONTEXT = np.uint64(mix_int(103))

WORDS, GRAMS = 0, 1
_PACKED = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("segment", pa.int32()), ("once", pa.binary()), ("more", pa.binary()), ("counts", pa.binary())])
PACKED = "kind int, slice int, segment int, once binary, more binary, counts binary"
_PART = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("segment", pa.int32()), ("size", pa.int64()), ("total", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
PART = "kind int, slice int, segment int, size long, total long, keys binary, counts binary"
_SHARD = pa.schema([("shard", pa.int64()), ("bytes", pa.int64()), ("docs", pa.binary())])
SHARD = "shard long, bytes long, docs binary"
_ASKED = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("segment", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary())])
ASKED = "kind int, slice int, segment int, shard long, keys binary"
_ANSWER = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("slice", pa.int32()), ("segment", pa.int32()), ("found", pa.binary())])
ANSWER = "shard long, kind int, slice int, segment int, found binary"
SCORES = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
])
_SCORES = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


class Layout:
    """How many slices and segments the model has; all from the bytes of text behind it."""

    def __init__(self, text_bytes: int, order: int, slice_bytes: int, segment_bytes: int):
        self.order, self.text_bytes = order, text_bytes
        # A word and its space take 2 bytes at least, about 6 on average; 6 bytes of model each.
        self.word_slices = max(1, math.ceil(text_bytes / 3 / slice_bytes))
        self.gram_slices = max(1, math.ceil((order - 1) * text_bytes / 3 / slice_bytes))
        self.word_segments = max(1, math.ceil(text_bytes / self.word_slices / (8 * segment_bytes)))
        self.gram_segments = max(1, math.ceil((order - 1) * text_bytes / self.gram_slices / segment_bytes))


def tokens_of(texts: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with an end after each, and tokens before each text."""
    hashes, offsets = word_hashes(texts, powers)
    n = len(texts)
    begins = offsets + np.arange(n + 1)
    tokens = np.empty(len(hashes) + n, np.uint64)
    ends = begins[1:] - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = hashes, END
    return tokens, begins


def grams_of(tokens: np.ndarray, begins: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order from 2 up: keys of each token's n-gram and of its context.

    Start signs stand before each text, as many as the longest context.
    """
    out, gram = [], tokens
    place = np.arange(len(tokens)) - np.repeat(begins[:-1], np.diff(begins))
    for size in range(2, order + 1):
        context = np.where(place > 0, np.concatenate([gram[:1], gram[:-1]]), mix(np.full(1, START + np.uint64(size), np.uint64))[0])
        gram = chained(context, tokens)
        out.append((gram, mix(context ^ CONTEXT)))
    return out


def tight(keys: np.ndarray, width: int) -> bytes:
    """Rising keys of ``width`` bytes: their number, a bit for each step of the first byte and a 1 for each key
    in its place, and the other bytes. So a key takes a byte less, and some 33 bytes more are sent.
    """
    if not len(keys):
        return b""
    marks = np.zeros(len(keys) + 256, np.uint8)
    marks[(keys >> np.uint64(8 * width - 8)).astype(np.int64) + np.arange(len(keys))] = 1
    low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : width - 1]
    return len(keys).to_bytes(4, "little") + np.packbits(marks).tobytes() + low.tobytes()


def loose(sent: bytes, width: int) -> bytes:
    """The keys of :func:`tight`, one after another in ``width`` bytes."""
    if not sent:
        return b""
    n = int.from_bytes(sent[:4], "little")
    low = 4 + (n + 263) // 8
    marks = np.unpackbits(np.frombuffer(sent, np.uint8, low - 4, 4))[: n + 256]
    raw = np.empty((n, width), np.uint8)
    raw[:, : width - 1] = np.frombuffer(sent, np.uint8, offset=low).reshape(n, width - 1)
    raw[:, width - 1] = np.flatnonzero(marks) - np.arange(n)
    return raw.tobytes()


def _pack(kind: int, part: np.ndarray, keys: np.ndarray, counts: np.ndarray, segments: int, width: int):
    """One row per part: its keys met once, and the others with counts. Keys stand in order of their parts, and
    in a part in their own.
    """
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
        more = counts[a:b] > 1
        at = int(part[a])
        yield kind, at // segments, at % segments, tight(keys[a:b][~more], width), tight(keys[a:b][more], width), counts[a:b][more].astype("<i8").tobytes()


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


#: Bytes of an n-gram's key that count; its segment holds few enough for them.
GRAM_WIDTH = 6


def _word_part(tokens: np.ndarray, layout: Layout) -> np.ndarray:
    """Slice and segment of words, as one number: a range of hashes."""
    return ((tokens >> np.uint64(32)) * np.uint64(layout.word_slices * layout.word_segments) >> np.uint64(32)).astype(np.int64)


def _counter(layout: Layout, count_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for shard in by_bytes(batches, count_bytes):
            tokens, begins = tokens_of(shard.column("__text").combine_chunks(), powers)
            keys, counts = _distinct(tokens)
            rows = list(_pack(WORDS, _word_part(keys, layout), keys, counts, layout.word_segments, 8))
            grams = [keys for gram, context in grams_of(tokens, begins, layout.order) for keys in (gram, context)]
            if grams:
                short, part = _short(np.concatenate(grams), layout.gram_slices * layout.gram_segments)
                if layout.gram_slices * layout.gram_segments < 1 << 16:
                    keys, counts = _distinct(part.astype(np.uint64) << np.uint64(48) | short)
                    part, keys = (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1)
                else:
                    order = np.lexsort((short, part))
                    part, keys, counts = part[order], short[order], np.ones(len(order), np.int64)
                rows.extend(_pack(GRAMS, part, keys, counts, layout.gram_segments, GRAM_WIDTH))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PACKED.types)], schema=_PACKED)

    return run


def _short(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of a key that tells it from others of its segment, and the segment."""
    return keys >> np.uint64(64 - 8 * GRAM_WIDTH), ((keys & np.uint64(0xFFFFFFFF)) % np.uint64(segments)).astype(np.int64)


def _wide(raw: list[bytes], width: int) -> np.ndarray:
    short = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, width)
    full = np.zeros((len(short), 8), np.uint8)
    full[:, :width] = short
    return full.view("<u8").ravel()


def _hashed(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the bits of (key, level)."""
    start = mix(keys + np.uint64(mix_int(level)))
    return start, start >> np.uint64(32) | np.uint64(1)


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    kind, part, segment = (k.as_py() for k in key)
    width = 8 if kind == WORDS else GRAM_WIDTH
    once, more = _wide(rows.column("once").to_pylist(), width), _wide(rows.column("more").to_pylist(), width)
    counts = np.concatenate([np.ones(len(once), np.int64), np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<i8")])
    keys, where = np.unique(np.concatenate([once, more]), return_inverse=True)
    total = np.bincount(where, counts, len(keys)).astype(np.int64)
    if kind == WORDS:
        size, held, counted = len(keys), keys.tobytes(), total.tobytes()
    else:
        levels = np.floor(np.log2(total)).astype(np.int64) + 1
        size = max(64, -(-int(levels.sum()) * BITS // 64) * 64)
        bits = np.zeros(size, bool)
        for level in range(1, int(levels.max()) + 1):
            start, step = _hashed(keys[levels >= level], level)
            for k in range(HASHES):
                bits[(start + step * np.uint64(k)) % np.uint64(size)] = True
        held, counted = np.packbits(bits, bitorder="little").tobytes(), b""
    values = [kind, part, segment, size, int(total.sum()), held, counted]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, _PART.types)], schema=_PART)


def _segment(key: tuple, rows: pa.Table) -> pa.Table:
    width = 8 if key[0].as_py() == WORDS else GRAM_WIDTH
    for name in ("once", "more"):
        keys = pa.array([loose(sent, width) for sent in rows.column(name).to_pylist()], pa.binary())
        rows = rows.set_column(rows.column_names.index(name), name, keys)
    return _build(key, rows)


def train(docs: DataFrame, *, text_col: str = "text", order: int = ORDER, slice_bytes: int = SLICE_BYTES, segment_bytes: int = SEGMENT_BYTES) -> tuple[DataFrame, Layout]:
    """The model of ``docs``: one row per segment, in the shared folder, and its layout.

    Null text counts as empty: it has one token, the end.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    layout = Layout(size, order, slice_bytes, segment_bytes)
    packed = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).mapInArrow(_counter(layout, COUNT_BYTES), PACKED)
    return stored(packed.groupBy("kind", "slice", "segment").applyInArrow(_segment, PART)), layout


def count_words(held: tuple[np.ndarray, np.ndarray], tokens: np.ndarray) -> np.ndarray:
    keys, counts = held
    if not len(keys):
        return np.zeros(len(tokens), np.int64)
    asked, where = np.unique(tokens, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, counts[at], 0).astype(np.int64)[where]


def _levels(held: tuple[np.ndarray, np.ndarray, np.ndarray], short: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Levels that the filter has for the keys, 0 for none: level after level is probed."""
    bits, begins, sizes = held
    levels, left, level = np.zeros(len(short), np.int64), np.arange(len(short)), 1
    while len(left):
        start, step = _hashed(short[left], level)
        for k in range(HASHES):
            part = segment[left]
            at = begins[part] + ((start + step * np.uint64(k)) % sizes[part]).astype(np.int64)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            left, start, step = left[hit], start[hit], step[hit]
        levels[left] = level
        level += 1
    return levels


def _expected(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, (3 * np.exp2(levels - 1.0) - 1) / 2, 0.0)


def count_grams(held: tuple[np.ndarray, np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Expected counts of the levels that the filter has for the keys, 0 for none."""
    return _expected(_levels(held, *_short(keys, len(held[2]))))


def _placed(part: np.ndarray, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a part and a key of 48 bits, in order, and where each pair stands among them."""
    if parts < 1 << 16:
        pairs, where = np.unique(part.astype(np.uint64) << np.uint64(48) | keys, return_inverse=True)
        return (pairs >> np.uint64(48)).astype(np.int64), pairs & np.uint64((1 << 48) - 1), where
    order = np.lexsort((keys, part))
    part, keys = part[order], keys[order]
    first = np.ones(len(order), bool)
    first[1:] = (part[1:] != part[:-1]) | (keys[1:] != keys[:-1])
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(first) - 1
    return part[first], keys[first], where


def _packer(text_name: str, shard_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, docs in enumerate(by_bytes((b for b in batches if b.num_rows), shard_bytes)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=PACK_LEVEL))) as writer:
                writer.write_table(docs.combine_chunks())
            values = [first + k, docs.column(text_name).nbytes, sink.getvalue().to_pybytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _SHARD.types)], schema=_SHARD)

    return run


def _asker(layout: Layout, text_name: str) -> Callable:
    """For each shard: the distinct keys that it has in each segment, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for number, raw in zip(batch.column("shard").to_pylist(), batch.column("docs")):
                docs = pa.ipc.open_stream(raw.as_buffer()).read_all()
                words, _, grams, _, _ = _keys(docs, layout, text_name, powers)
                rows = []
                for kind, (part, keys), segments, width in ((WORDS, words, layout.word_segments, 8), (GRAMS, grams, layout.gram_segments, GRAM_WIDTH)):
                    packed = _pack(kind, part, keys, np.ones(len(keys), np.int64), segments, width)
                    rows.extend((kind, slice_, segment, number, once) for kind, slice_, segment, once, _, _ in packed)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ASKED.types)], schema=_ASKED)

    return run


def _keys(docs: pa.Table, layout: Layout, text_name: str, powers: Powers):
    """Distinct words and n-gram keys of a shard with their parts, where each token's stand among them
    (n-gram and context, order after order), and tokens before each text. The same for the same shard.
    """
    tokens, begins = tokens_of(docs.column(text_name).combine_chunks(), powers)
    words, word_at = np.unique(tokens, return_inverse=True)
    grams = [keys for gram, context in grams_of(tokens, begins, layout.order) for keys in (gram, context)]
    parts = layout.gram_slices * layout.gram_segments
    short, part = _short(np.concatenate([np.zeros(0, np.uint64), *grams]), parts)
    part, short, gram_at = _placed(part, short, parts)
    return (_word_part(words, layout), words), word_at, (part, short), gram_at.reshape(len(grams), len(tokens)), begins


def _answer(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
    """What a segment has for the keys of all shards: counts of words, or levels of n-grams as bytes."""
    kind = key[1].as_py()
    width = 8 if kind == WORDS else GRAM_WIDTH
    raw = [loose(sent, width) for sent in asked.column("keys").to_pylist()]
    keys = _wide(raw, width)
    if not model.num_rows:
        found = np.zeros(len(keys), np.int64)
    elif kind == WORDS:
        found = count_words(tuple(np.frombuffer(model.column(c)[0].as_py(), t) for c, t in (("keys", np.uint64), ("counts", np.int64))), keys)
    else:
        bits = np.frombuffer(model.column("keys")[0].as_py(), np.uint8)
        held = (bits, np.zeros(1, np.int64), np.array([model.column("size")[0].as_py()], np.uint64))
        found = _levels(held, keys, np.zeros(len(keys), np.int64))
    found = found.astype("<i8" if kind == WORDS else np.uint8)
    ends = np.cumsum([len(r) // width for r in raw]).tolist()
    cut = [found[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
    return pa.Table.from_arrays([*[asked.column(c) for c in ("shard", "kind", "slice", "segment")], pa.array(cut, pa.binary())], schema=_ANSWER)


def _scorer(layout: Layout, totals: tuple[int, int], pseudo: float, text_name: str, names: list[str]) -> Callable:
    def run(key: tuple, packed: pa.Table, answers: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(packed.column("docs")[0].as_buffer()).read_all()
        n = docs.num_rows
        _, word_at, _, gram_at, begins = _keys(docs, layout, text_name, Powers())
        answers = answers.sort_by([(c, "ascending") for c in ("kind", "slice", "segment")])
        found = {kind: b"".join(f for k, f in zip(answers.column("kind").to_pylist(), answers.column("found").to_pylist()) if k == kind) for kind in (WORDS, GRAMS)}
        counts = np.frombuffer(found[WORDS], "<i8")[word_at]
        levels = _expected(np.frombuffer(found[GRAMS], np.uint8).astype(np.int64))
        base = p = (counts + 0.1) / (totals[0] + 0.1 * (totals[1] + 1))
        for gram, context in zip(gram_at[::2], gram_at[1::2]):
            seen = levels[context]
            p = (np.minimum(levels[gram], seen) + pseudo * p) / (seen + pseudo)
        doc = np.repeat(np.arange(n), np.diff(begins))
        new = [np.diff(begins), np.bincount(doc, counts > 0, n), np.bincount(doc, np.log10(base), n), np.bincount(doc, np.log10(p), n)]
        struct = pa.StructArray.from_arrays([pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(new, _FIELDS)], fields=list(_SCORES))
        return docs.select(names).append_column("lm", struct)

    return run


_FIELDS = [f.type for f in _SCORES]


def score(docs: DataFrame, model: DataFrame, layout: Layout, *, text_col: str = "text", pseudo: float = PSEUDO, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All columns of ``docs`` and a struct ``lm``: n_tokens, n_known, base_score, score (log10).

    Null text counts as empty: one token, the end. Repeated rows are scored alike. A column ``lm``
    of ``docs`` is replaced. Without training texts every known count is 0.
    """
    docs = docs.drop("lm", "train_tokens")
    spark, text_name = docs.sparkSession, text_col
    small_batches(spark)
    sums = model.filter(F.col("kind") == WORDS).agg(F.sum("total"), F.sum("size")).first()
    totals = (sums[0] or 0, sums[1] or 0)
    wide = docs
    if docs.schema[text_col].dataType != T.StringType():
        text_name = free_name(docs, "__text")
        wide = docs.withColumn(text_name, F.col(text_col).cast("string"))
    packed = stored(wide.mapInArrow(_packer(text_name, shard_bytes), SHARD))
    # If more text is scored than was learned from, several copies of a segment answer.
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    copies = max(1, round(size / max(layout.text_bytes, MEET_BYTES)))
    key = ["copy", "kind", "slice", "segment"]
    asked = packed.mapInArrow(_asker(layout, text_name), ASKED).withColumn("copy", F.pmod(F.xxhash64("shard"), F.lit(copies)))
    held = model.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    answers = asked.groupBy(key).cogroup(held.groupBy(key)).applyInArrow(_answer, ANSWER)
    kinds = T.StructType([*docs.schema.fields, T.StructField("lm", SCORES)])
    out = packed.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_scorer(layout, totals, pseudo, text_name, docs.columns), kinds)
    return out.withColumn("train_tokens", F.lit(totals[0]).cast("long"))


def held_out(id_col: str = "doc_id") -> Column:
    """One document in ten by its id; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


def learn_and_score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Learns from the documents that are not held out and scores all."""
    model, layout = train(docs.filter(~held_out(id_col)), text_col=text_col, **options)
    return score(docs.withColumn("held_out", held_out(id_col)), model, layout, text_col=text_col)
