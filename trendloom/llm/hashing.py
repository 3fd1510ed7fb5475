"""Hashes of words over whole Arrow batches, without a Python step per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from trendloom.llm.shared import LOWER, mix, mix_int

#: Base of the rolling hash (odd, so it can be divided out modulo 2**64), and its inverse.
BASE = mix_int(0x1234567) | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes of text that are hashed at a time; each takes about 40 bytes of memory meanwhile.
STEP = 1 << 20

_LOWER = np.frombuffer(LOWER, np.uint8)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class Powers:
    """Powers of the base and of its inverse, as many as the longest batch so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << max(16, (n - 1).bit_length())
            fill = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
            self.up, self.down = fill(BASE), fill(INVERSE)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one more entry for the end)."""
    texts = texts.cast(pa.large_binary())
    lengths = np.array(texts.is_valid().to_numpy(zero_copy_only=False), np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    if len(texts) and not lengths.all():  # a null may hide bytes
        keep = [raw[a - offsets[0] : b - offsets[0]] for a, b, ok in zip(offsets[:-1], offsets[1:], lengths) if ok]
        sizes = (offsets[1:] - offsets[:-1]) * lengths
        raw = np.concatenate(keep) if keep else np.zeros(0, np.uint8)
        return raw, np.concatenate([[0], np.cumsum(sizes)])
    return raw, offsets - offsets[0]


def word_hashes(texts: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (split at white space, A-Z lower-cased), and words before each text."""
    raw, offsets = flat(texts)
    hashes, begins, at = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    cuts = np.unique(np.searchsorted(offsets, np.arange(0, len(raw) + STEP, STEP), "left")).clip(0, len(offsets) - 1)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own, before = _hashes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], powers)
        hashes.append(own)
        begins.append(before[1:] + at)
        at += len(own)
    return np.concatenate(hashes), np.concatenate([*begins, np.full(len(offsets) - 1 - (cuts[-1] if len(cuts) else 0), at)])


def _hashes(raw: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The same for one step. The hash of a word is a sum of byte values times powers of the base,
    a difference of running sums divided by the power at its start.
    """
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    powers.grow(len(raw) + 1)
    raw = _LOWER[raw]
    space = _SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins = ~space
    begins[1:] &= space[:-1] | edge[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers.up[: len(raw)], out=sums[1:])
    hashes = mix((sums[stops + 1] - sums[starts]) * powers.down[starts] + (stops - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of all but its last word and that of the last."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)
