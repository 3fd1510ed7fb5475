"""Removal of long repeated byte strings, by a run-length index over the places that may repeat.

Equal strings of ``length`` bytes have the same least k-mer (by hash) at the same place. So each
string belongs to one anchor, and the strings of an anchor make one context, a piece of text. Only
anchors that occur twice matter. However often a context occurs, two copies of it stand for all. The
contexts go, by anchor, into shards of bounded size. Each shard is indexed by its Burrows-Wheeler transform, kept as
runs with samples at the run ends. Streaming the text along these samples gives, for each position,
its longest match elsewhere in the shard: within a run the match of a position is that of the one
before it, less a byte, so only run ends are compared. These matches alone say which bytes go.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.hashing import Powers, flat
from trendloom.llm.shared import by_bytes, mix, small_batches, stored
from trendloom.operators.settle import settle

LENGTH, KMER = 200, 64
#: Text bytes of a scanned batch, context bytes of a shard, contexts of an anchor that go to one shard.
SCAN_BYTES, SHARD_BYTES, MOST_CONTEXTS = 2 << 20, 2 << 20, 256

#: Run borders that are compared at once.
BORDERS = 1 << 16

_VALUES = mix(np.arange(1000, 1256, dtype=np.uint64))
PLACES = "key long, digest long, doc long, start int, size int, anchor int"
_PLACES = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("anchor", pa.int32())])
CONTEXTS = "key long, digest long, pid long, at int, anchor int, low int, high int, n long, bytes binary"
_CONTEXTS = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("pid", pa.int64()), ("at", pa.int32()), ("anchor", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("n", pa.int64()), ("bytes", pa.binary())])
SPANS = "key long, digest long, spans array<array<int>>"
_SPANS = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32())))])


def _sums(raw: np.ndarray, powers: Powers) -> np.ndarray:
    powers.grow(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers.up[: len(raw)], out=sums[1:])
    return sums


def _hash(sums: np.ndarray, powers: Powers, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the strings between positions, equal for equal strings wherever they stand."""
    return mix((sums[stop] - sums[start]) * powers.down[start] + (stop - start).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima over blocks."""
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def find_places(raw: np.ndarray, offsets: np.ndarray, powers: Powers, length: int, kmer: int):
    """All contexts of the texts: anchor hash, context hash, text, start in it, size, anchor in the context."""
    width = length - kmer + 1
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    sums = _sums(raw, powers)
    at = np.arange(len(raw) - kmer + 1)
    bits = np.uint64(max(22, int(len(raw)).bit_length()))
    ranked = _hash(sums, powers, at, at + kmer) >> bits << bits | at.astype(np.uint64)
    anchor = (sliding_least(ranked, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + length <= offsets[text + 1]
    starts, anchor, text = starts[inside], anchor[inside], text[inside]
    if not len(starts):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(first[1:], len(starts)) - 1
    begin, end, spot = starts[first], starts[last] + length, anchor[first]
    key = _hash(sums, powers, spot, spot + kmer)
    digest = mix(_hash(sums, powers, begin, end) ^ (spot - begin).astype(np.uint64))
    return key, digest, text[first], begin - offsets[text[first]], end - begin, spot - begin


def _placer(length: int, kmer: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for part in by_bytes(batches, SCAN_BYTES):
            raw, offsets = flat(part.column("text").combine_chunks())
            key, digest, text, start, size, anchor = find_places(raw, offsets, powers, length, kmer)
            docs = part.column("doc").to_numpy()[text]
            columns = [key.view(np.int64), digest.view(np.int64), docs, start.astype(np.int32), size.astype(np.int32), anchor.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PLACES)

    return run


# ---- the index of one shard ---------------------------------------------------------------


def symbols_left(text: np.ndarray) -> np.ndarray:
    """Symbols from each place to the 0, or the end of the text, that closes its suffix."""
    stops = np.append(np.flatnonzero(text == 0), len(text))
    return np.repeat(stops, np.diff(stops, prepend=-1))[: len(text)] - np.arange(len(text))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols 0 to 256, by tripling the length of ranked prefixes (doubling, if the text is long).

    Each 0, and the end of the text, closes a suffix; closed suffixes that are equal follow in order of
    place. A rank is the first place of its prefix, so only suffixes that share one are sorted again.
    """
    n, span = len(text), 7
    bits = np.uint64(21 if n < 1 << 21 else 32)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(span, np.uint64)])
    two = padded[:-1] << np.uint64(9) | padded[1:]
    key = (two[:n] << np.uint64(18) | two[2 : n + 2]) << np.uint64(27) | two[4 : n + 4] << np.uint64(9) | padded[6 : n + 6]
    left = symbols_left(text)
    whole = (1 << 9 * span) - 1
    key &= np.array([whole - (whole >> 9 * k) for k in range(span + 1)], np.uint64)[np.minimum(left, span)]
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    ends = np.flatnonzero((left < span)[order])
    order[ends] = order[ends][np.lexsort((order[ends], key[ends]))]
    head[ends] = True
    rank, places = np.zeros(n + 1, np.uint32), np.arange(n)
    while True:
        rank[order[places]] = np.maximum.accumulate(np.where(head, places, 0)) + 1
        places = places[~head | ~np.append(head[1:], True)]
        if not len(places):
            return order
        tied = order[places]
        key = rank[tied].astype(np.uint64) << bits | rank[tied + span]
        if bits == 21:  # three ranks fit; the third counts if the second is shared, and then lies in the text
            key = key << bits | rank[np.minimum(tied + 2 * span, n)]
        again = np.argsort(key)
        order[places], key = tied[again], key[again]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        span *= 3 if bits == 21 else 2


class RunIndex:
    """Runs of the Burrows-Wheeler transform, with the text positions at both ends of each run.

    Each 0 of the text is a symbol of its own, so no match runs across one.
    """

    def __init__(self, text: np.ndarray, order: np.ndarray | None = None):
        self.n = len(text)
        order = suffix_order(text) if order is None else order
        self.text = text
        own = np.where(text > 0, text.astype(np.int32), -1 - np.arange(self.n, dtype=np.int32))
        symbols = np.where(order > 0, own[order - 1], -1 - self.n)  # nothing stands before the text
        heads = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        #: First position of each run but the first, and the last position of the run before it.
        self.first, self.last = order[heads], order[heads - 1]
        self.runs = len(heads) + 1

    def common(self, most: int) -> np.ndarray:
        """Bytes that the neighbours at each run border share, up to ``most``; compared eight at a time, a block
        of borders after another.
        """
        raw = np.zeros(self.n + 8, np.uint8)
        raw[: self.n] = self.text - 1  # what stands for a 0 is of no account, as no match reaches one
        words = np.ascontiguousarray(np.ndarray(self.n, "<u8", raw, strides=(1,)))
        left = symbols_left(self.text)
        bound = np.minimum(np.minimum(left[self.first], left[self.last]), most)
        shared = np.zeros(len(self.first), np.int64)
        for start in range(0, len(shared), BORDERS):
            open_ = start + np.flatnonzero(bound[start : start + BORDERS] > 0)
            while len(open_):
                so_far = shared[open_]
                differ = words[self.first[open_] + so_far] ^ words[self.last[open_] + so_far]
                same = np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3
                shared[open_] = so_far = so_far + same
                open_ = open_[(same == 8) & (so_far < bound[open_])]
        return np.minimum(shared, bound)

    def matching(self, most: int) -> np.ndarray:
        """For each position, the longest match that starts at any other position."""
        shared = self.common(most)
        best = np.zeros(self.n, np.int64)
        for border in (self.first, self.last):
            reach = np.zeros(self.n, np.int64)
            reach[border] = shared + border
            best = np.maximum(best, np.maximum.accumulate(reach) - np.arange(self.n))
        return np.maximum(best, 0)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Union of half-open ranges, in order; ranges that touch become one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(order) else ends
    cut = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]])) if len(starts) else np.zeros(0, np.int64)
    last = np.append(cut[1:], len(starts)) - 1 if len(starts) else cut
    return np.stack([starts[cut], ends[last]], axis=1).tolist()


def joined(contexts: list[bytes]) -> np.ndarray:
    """The contexts as symbols 1 to 256, a 0 after each."""
    text = np.frombuffer(b"\0".join([*contexts, b""]), np.uint8).astype(np.int16) + np.int16(1)
    text[np.cumsum([len(c) + 1 for c in contexts]) - 1] = 0
    return text


def twofold_order(contexts: list[bytes], copies: np.ndarray) -> np.ndarray:
    """Suffix order of the contexts with each given once or twice in succession.

    Equal suffixes follow in order of place, so those of a second copy stand next to the first one's
    and only the different contexts are sorted.
    """
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    once, many = np.cumsum(sizes) - sizes, np.cumsum(sizes * copies) - sizes * copies
    order = suffix_order(joined(contexts))
    owner = np.repeat(np.arange(len(sizes)), sizes)[order]
    times = copies[owner]
    out = np.repeat(order - once[owner] + many[owner], times)
    out[np.cumsum(times)[times > 1] - 1] += sizes[owner[times > 1]]
    return out


def repeated_spans(contexts: list[bytes], copies: np.ndarray, length: int) -> list[list[list[int]]]:
    """Ranges of each context that strings of ``length`` bytes cover which start twice in the contexts.

    The contexts differ; ``copies`` says whether one counts once or twice.
    """
    text = joined([c for c, n in zip(contexts, copies.tolist()) for _ in range(n)])
    matches = RunIndex(text, twofold_order(contexts, copies)).matching(max(map(len, contexts)))
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    begins = np.cumsum(sizes * copies) - sizes * copies
    starts = np.flatnonzero(matches >= length)
    spans = np.array(merged(starts, starts + length), np.int64).reshape(-1, 2)
    owner = np.searchsorted(begins, spans[:, 0], "right") - 1
    spans -= begins[owner][:, None]
    out: list[list[list[int]]] = [[] for _ in contexts]
    for k, span in zip(owner.tolist(), spans.tolist()):
        if span[0] < len(contexts[k]):  # the second copy has the same ranges
            out[k].append(span)
    return out


def _indexed(length: int) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        copies = np.minimum(rows.column("copies").to_numpy(), 2)
        spans = repeated_spans(rows.column("bytes").to_pylist(), copies, length)
        found = np.array([bool(s) for s in spans], bool)
        held = rows.select(["key", "digest"]).filter(pa.array(found)).combine_chunks()
        return pa.Table.from_arrays([held.column(0), held.column(1), pa.array([s for s in spans if s], _SPANS.types[2])], schema=_SPANS)

    return run


# ---- contexts -------------------------------------------------------------------------------


def _cutter(width: int) -> Callable:
    """Bytes of the contexts that a document stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    piece = raw[w["start"] : w["start"] + w["size"]]
                    rows.append((w["key"], w["digest"], w["pid"], 0, w["anchor"], 0, width, w["n"], piece))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CONTEXTS.types)], schema=_CONTEXTS)

    return run


def _digest(*parts: bytes) -> int:
    state = hashlib.blake2b(digest_size=8)
    for part in parts:
        state.update(len(part).to_bytes(4, "little") + part)
    return int.from_bytes(state.digest(), "little", signed=True)


def _halver(length: int) -> Callable:
    """Each context as two, by how far before the anchor a string starts.

    The strings of a half share more than the anchor, and the key takes in what they share. So the
    contexts of an anchor in many different surroundings part into groups of equal or single ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                anchor, context = row["anchor"], row["bytes"]
                middle = (row["low"] + row["high"]) // 2
                for low, high in ((row["low"], middle), (middle, row["high"])):
                    # A string that starts r bytes before the anchor, low <= r < high, within the context.
                    far, near = min(high - 1, anchor), max(low, anchor - (len(context) - length))
                    if far < near or high <= low:
                        continue
                    piece = context[anchor - far : anchor - near + length]
                    shared = context[anchor - low : anchor - (high - 1) + length]
                    key = _digest(row["key"].to_bytes(8, "little", signed=True), bytes([low, high]), shared)
                    digest = _digest(piece, far.to_bytes(4, "little"))
                    rows.append((key, digest, row["pid"], row["at"] + anchor - far, far, low, high, row["n"], piece))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CONTEXTS.types)], schema=_CONTEXTS)

    return run


def _resolve(contexts: DataFrame, length: int, width: int, shard_bytes: int, most: int) -> DataFrame:
    """``(pid, spans)``: repeated ranges of each context, relative to the piece of text it came from."""
    found = None
    for _ in range(width.bit_length() + 1):
        kinds = contexts.groupBy("key", "digest").agg(F.sum("n").alias("copies"), F.min("pid").alias("stands"), F.max(F.octet_length("bytes")).alias("octets"))
        keys = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all"), F.sum("octets").alias("sum_octets")).filter("all > 1")
        known = stored(kinds.join(keys, "key"))
        small = known.filter(F.col("kinds") <= most)
        size = small.agg(F.sum(F.col("octets") * F.least("copies", F.lit(2)))).first()[0] or 0
        shards = max(1, math.ceil(size / shard_bytes))
        pieces = contexts.join(small.select("key", "digest", F.col("stands").alias("pid"), "copies"), ["key", "digest", "pid"])
        spans = pieces.select("key", "digest", "copies", "bytes", F.pmod("key", F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(_indexed(length), SPANS)
        placed = contexts.select("key", "digest", "pid", "at").join(spans, ["key", "digest"]).select(
            "pid", F.transform("spans", lambda s: F.array(s[0] + F.col("at"), s[1] + F.col("at"))).alias("spans")
        )
        placed = stored(placed)
        found = placed if found is None else found.unionByName(placed)
        large = keys.filter(F.col("kinds") > most).select("key")
        again, count = settle(contexts.join(large, "key", "left_semi").filter("high - low > 1").mapInArrow(_halver(length), CONTEXTS))
        if not count:
            break
        contexts = again
    return found


def _remover() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column("__text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                ranges = np.array([s for group in spans or [] for s in group], np.int64).reshape(-1, 2)
                ranges = merged(ranges[:, 0], ranges[:, 1])
                pieces, at = [], 0
                for a, b in ranges:
                    pieces.append(raw[at:a])
                    at = b
                totals.append(len(raw))
                removed.append(sum(b - a for a, b in ranges))
                runs.append(ranges)
                kept.append(b"".join([*pieces, raw[at:]]))
            names = [c for c in batch.schema.names if c not in ("__text", "spans")]
            arrays = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *arrays], names=[*names, "n_bytes", "n_removed", "removed", "kept"])

    return run


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, kmer: int = KMER,
    shard_bytes: int = SHARD_BYTES, most: int = MOST_CONTEXTS,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, removed (byte ranges), kept (bytes)`` for each row of ``docs``.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else, in this
    document or another. Null and empty texts, and texts shorter than ``length``, lose nothing.
    Repeated rows count as documents, so both lose all that is long enough. Only id and text are
    read. Hot contexts meet as counts, and two copies go to the index; an anchor in more than ``most``
    different contexts is halved until each part has fewer, or holds single strings, and the parts go to the index.
    """
    small_batches(docs.sparkSession)
    width = length - kmer + 1
    texts = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("doc", F.xxhash64(id_col, "text"))
    # Stored: hashing a text costs more than its places read again.
    places = stored(texts.filter(F.octet_length("text") >= length).select("doc", "text").mapInArrow(_placer(length, kmer), PLACES))
    twice = stored(places.groupBy("key").agg(F.count(F.lit(1)).alias("all")).filter("all > 1").select("key"))
    again = stored(places.join(twice, "key"))
    kinds = again.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("stands"))
    met = stored(again.join(kinds, ["key", "digest"]).withColumn("stands", F.col("doc") == F.col("stands")))
    pid = F.xxhash64("key", "digest")
    wanted = met.filter("stands").dropDuplicates(["key", "digest"]).groupBy("doc").agg(
        F.collect_list(F.struct("key", "digest", pid.alias("pid"), "start", "size", "anchor", "n")).alias("wanted")
    )
    sources = texts.select("doc", "text").join(wanted, "doc").dropDuplicates(["doc"]).select("text", "wanted")
    contexts = stored(sources.mapInArrow(_cutter(width), CONTEXTS))
    spans = _resolve(contexts, length, width, shard_bytes, most).groupBy("pid").agg(F.flatten(F.collect_list("spans")).alias("found"))
    ranges = met.join(spans, pid == F.col("pid")).select(
        "doc", F.transform("found", lambda s: F.array(s[0] + F.col("start"), s[1] + F.col("start"))).alias("spans")
    )
    ranges = ranges.groupBy("doc").agg(F.collect_list("spans").alias("spans"))
    joined = texts.join(ranges, "doc", "left").select(id_col, F.col("text").alias("__text"), "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_remover(), f"`{id_col}` {kind}, n_bytes long, n_removed long, removed array<array<long>>, kept binary")
