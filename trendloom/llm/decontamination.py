"""Benchmark decontamination: suffix arrays over training documents, searched by benchmark suffixes.

Every task cuts its documents into shards of bounded size and builds a suffix array over the words
of each shard. The benchmark suffixes are binary-searched in it, which gives the places of all
windows and the longest verbatim match of each place. Nothing is shuffled, and a passage that many
documents share costs each shard only its own copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.shared import by_bytes, free_name, small_batches

WINDOW = 13
#: Text bytes of one shard, and of one block of the benchmark.
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20

#: Letters and digits (A-Z as a-z) and everything beyond ASCII; other bytes part words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("longest_words", T.LongType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item", T.StringType()),
])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("item_ids", pa.list_(pa.string())),
    ("longest_words", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string()),
])


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class Suffixes:
    """Benchmark suffixes as rows of word numbers, cut to the window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.numbers: dict[bytes, int] = {}
        flat, starts, lengths, owners = [0], [], [], []
        self.ids = [item for item, _ in items]
        for k, (_, text) in enumerate(items):
            at = len(flat)
            flat.extend(self.numbers.setdefault(w, len(self.numbers) + 1) for w in text)
            flat.append(0)
            size = min(window, len(text))
            for start in range(at, at + len(text) - size + 1 if text else at):
                starts.append(start)
                lengths.append(size)
                owners.append(k)
        self.flat = np.array(flat + [0] * window, np.int32)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.owners = np.array(owners, np.int64)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes that begin with a known word, in order of their first ``depth`` words.

    Number 0 (unknown word, end of a document) ends a suffix. Ranks of prefixes are doubled.
    """
    at = np.flatnonzero(ids)
    rank = np.zeros(len(ids) + 2 * depth, np.int64)
    rank[: len(ids)] = ids
    order, span = np.argsort(rank[at], kind="stable"), 1
    while span < depth:
        follow = rank[at + span]
        key = rank[at] * (int(rank.max()) + 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(len(at), np.int64)
        new[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)])) if len(at) else 0
        rank[at] = new
        span *= 2
    return at[order]


def _bound(ids: np.ndarray, order: np.ndarray, rows: np.ndarray, mask: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all rows at once: the first suffix not below (``after``: above) each row."""
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
    columns = np.arange(rows.shape[1])
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        differ = (ids[order[middle][:, None] + columns] - rows[open_]) * mask[open_]
        first = np.argmax(differ != 0, axis=1)
        sign = differ[np.arange(len(open_)), first]
        below = sign <= 0 if after else sign < 0
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def search(texts: list[list[bytes]], found: Suffixes, window: int):
    """Hit word runs, items and the longest match (words, place, item) for each document of a shard."""
    get = found.numbers.get
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.zeros(len(texts), np.int64)
    np.cumsum(lengths[:-1] + 1, out=begin[1:])
    ids = np.zeros(int(lengths.sum()) + len(texts) + window, np.int32)
    for at, text in zip(begin.tolist(), texts):
        ids[at : at + len(text)] = [get(w, 0) for w in text]
    empty = [([], set(), (0, None, None)) for _ in texts]
    order = suffix_array(ids[: len(ids) - window], window)
    if not len(order) or not len(found.starts):
        return empty
    columns = np.arange(window)
    mask = (columns < found.lengths[:, None]).astype(np.int32)
    rows = found.flat[found.starts[:, None] + columns] * mask
    low = _bound(ids, order, rows, mask, False)
    counts = _bound(ids, order, rows, mask, True) - low
    total = int(counts.sum())
    if not total:
        return empty
    which = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    place = order[low[which] + offset]
    # Runs of hit words: openings minus closings, summed up from left to right.
    edge = np.bincount(place, minlength=len(ids) + 1)
    edge -= np.bincount(place + found.lengths[which], minlength=len(ids) + 1)
    inside = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
    change = np.diff(inside)
    firsts, lasts = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    for first, last, doc in zip(firsts.tolist(), lasts.tolist(), (np.searchsorted(begin, firsts, "right") - 1).tolist()):
        empty[doc][0].append([first - int(begin[doc]), last - int(begin[doc])])
    doc_of = np.searchsorted(begin, place, "right") - 1
    for pair in np.unique(doc_of * len(found.ids) + found.owners[which]).tolist():
        item = found.ids[pair % len(found.ids)]
        if item is not None:
            empty[pair // len(found.ids)][1].add(item)
    # Longest match: only places whose previous words differ can start one.
    test = found.starts[which]
    opens = (found.flat[test - 1] == 0) | (place == 0) | (found.flat[test - 1] != ids[place - 1])
    test, place, doc_of, owner = test[opens], place[opens], doc_of[opens], found.owners[which][opens]
    size = found.lengths[which][opens].copy()
    grow = np.arange(len(size))
    while len(grow):
        nxt = found.flat[test[grow] + size[grow]]
        grow = grow[(nxt != 0) & (nxt == ids[np.minimum(place[grow] + size[grow], len(ids) - 1)])]
        size[grow] += 1
    best = np.lexsort((owner, place, -size, doc_of))
    first = best[np.unique(doc_of[best], return_index=True)[1]]
    for k in first.tolist():
        doc = int(doc_of[k])
        longest = (int(size[k]), int(place[k] - begin[doc]), found.ids[int(owner[k])])
        empty[doc] = (empty[doc][0], empty[doc][1], longest)
    return empty


def merge(spans: list[list[int]]) -> list[list[int]]:
    """Union of word runs, in order; runs that touch become one."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _searcher(block, window: int, shard_bytes: int, text_name: str, output: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes(block.value, window)
        for shard in by_bytes(batches, shard_bytes):
            texts = [item_words(t) for t in shard.column(text_name).to_pylist()]
            old = shard.column(output).to_pylist()
            rows = []
            for text, before, (spans, items, longest) in zip(texts, old, search(texts, suffixes, window)):
                if before:
                    spans, items = merge(spans + before["spans"]), items | set(before["item_ids"])
                    longest = max(
                        (before["longest_words"], before["longest_at"], before["longest_item"]), longest,
                        key=lambda m: (m[0], -(m[1] or 0)),
                    )
                rows.append({
                    "n_words": len(text), "spans": spans, "item_ids": sorted(items), "longest_words": longest[0],
                    "longest_at": longest[1], "longest_item": longest[2],
                })
            at = shard.schema.get_field_index(output)
            done = shard.set_column(at, output, pa.array(rows, _ARROW)).combine_chunks()
            yield from done.to_batches()

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int):
    block, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for row in rows.toLocalIterator():
        text = item_words(row.t)
        if not text:
            continue
        block.append((row.i, text))
        size += len(row.t)
        if size >= most:
            yield block
            block, size = [], 0
    yield block


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
    output: str = "found",
) -> DataFrame:
    """All columns of ``docs`` and a struct ``output``: words, hit word runs ``[first, end)``, items,
    and the longest verbatim match with its place and item.

    A window is ``window`` consecutive words of an item (the whole item if it has fewer). Null and
    empty texts have no words; items without words never match; an item without an id counts for
    the runs but is not listed. Repeated rows are judged each for itself. The benchmark passes
    through the driver in blocks of ``block_bytes``; each block is a broadcast and a pass of its own
    over the same stream of documents, and all of them live until the plan has run. So the benchmark
    has to fit in a worker as a whole. A match is looked for where a window (or a short item)
    agrees; shorter ones are not reported as longest. A column of ``docs`` named as ``output`` is replaced.
    """
    docs = docs.drop(output)
    spark, text_name = docs.sparkSession, free_name(docs, "__text")
    small_batches(spark)
    kinds = T.StructType([*docs.schema.fields, T.StructField(text_name, T.StringType()), T.StructField(output, FOUND)])
    out = docs.select("*", F.col(text_col).cast("string").alias(text_name), F.lit(None).cast(FOUND).alias(output))
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        out = out.mapInArrow(_searcher(spark.sparkContext.broadcast(block), window, shard_bytes, text_name, output), kinds)
    return out.drop(text_name)


def judge(found: DataFrame, *, rate: int = 20) -> DataFrame:
    """Adds ``n_words, n_hit, n_items, items_sha256, contaminated``: at least 1 word in ``rate`` is hit."""
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.withColumns({
        "n_words": F.col("found.n_words"), "n_hit": n_hit, "n_items": F.size("found.item_ids").cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort("found.item_ids"), ","), 256),
        "contaminated": (n_hit > 0) & (rate * n_hit >= F.col("found.n_words")),
    })


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that no benchmark passage contaminates, with their columns."""
    name = free_name(docs, "found")
    found = find_benchmark(docs, benchmark, output=name, **options)
    n_hit = F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    bad = (n_hit > 0) & (20 * n_hit >= F.col(f"{name}.n_words"))
    return found.filter(~bad).select(*[f"`{c}`" for c in docs.columns])
