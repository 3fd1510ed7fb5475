"""SentencePiece encoding and decoding with seeded merge-dropout.

Merges are taken from an agenda, best rank first. A candidate that a keyed hash selects is skipped
when its turn comes, so the same text with the same seed always gets the same pieces, and other
seeds, documents and places get others. With ``dropout=0`` the pieces are the library's own.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.shared import by_bytes, free_name, mix, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A model is sent to the tasks with the plan; larger files are refused.
MODEL_BYTES = 32 << 20
DROPOUT, SEED = 0.1, 42
#: Ways in which the occurrences of one word may be drawn; None: each occurrence draws for itself.
DRAWS = None
#: Remembered words; the memory is emptied when it is full, which changes no result. Words that are
#: worked off together, and text bytes that are encoded together.
REMEMBERED, STEP, ENCODE_BYTES = 300_000, 20_000, 2 << 20

#: Spaces with the word behind them. No piece has a space behind another character, so no merge
#: crosses from one such chunk to the next.
_CHUNK = re.compile(" *[^ ]+| +")
SPACE = "▁"
#: The rank of a pair that is no piece, and the lengths up to which chunks are worked off together.
NEVER, WIDTHS = float("inf"), (4, 8, 12, 20, 32)

_MASK = (1 << 64) - 1


def skip_hash(key: int, start: int, split: int, end: int) -> int:
    """64-bit hash of a candidate merge, the pieces ``[start, split)`` and ``[split, end)`` of a chunk."""
    x = (key ^ (start << 42 | split << 21 | end)) * 0x9E3779B97F4A7C15 & _MASK
    return (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK


def skip_hashes(keys: np.ndarray, start: np.ndarray, split: np.ndarray, end: np.ndarray) -> np.ndarray:
    """:func:`skip_hash` of many candidates."""
    x = (keys ^ (start << 42 | split << 21 | end).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


RESULT = (
    T.StructField("n_pieces", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("lossless", T.BooleanType()),
)


class Model:
    """Tables of a merge-type model: pieces with a plain space, ranks, bytes of each piece."""

    def __init__(self, proto: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        if lib.normalize("a  b ") != f"{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("the model changes texts before it encodes them; it can't be lossless")
        self.ranks: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: list[bytes] = []
        fallback = {}
        for k in range(lib.vocab_size()):
            piece = lib.id_to_piece(k)
            if lib.is_byte(k):
                fallback[int(piece[3:5], 16)] = k
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(k) or lib.is_unknown(k) or lib.is_unused(k):
                self.bytes.append(b"")
            else:
                plain = piece.replace(SPACE, " ")
                if " " in plain.lstrip(" "):
                    raise ValueError(f"piece {piece!r} has a space inside")
                self.ranks[plain], self.ids[plain] = -lib.get_score(k), k
                self.bytes.append(plain.encode())
        if len(fallback) != 256:
            raise ValueError("the model has no piece for some bytes; it can't be lossless")
        self.fallback = [fallback[b] for b in range(256)]
        # Every pair of pieces that makes a piece, by the number of the pair, and what it makes.
        ids, self.size = self.ids, lib.vocab_size()
        pairs = sorted(
            (ids[piece[:k]] * self.size + ids[piece[k:]], number)
            for piece, number in ids.items() for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids
        )
        self._store_pairs(np.array([k for k, _ in pairs], np.int64), np.array([n for _, n in pairs], np.int32))
        self.rank_of = np.zeros(self.size, np.float32)
        self.rank_of[list(ids.values())] = [self.ranks[piece] for piece in ids]
        self.byte_at = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes])])
        self.all_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.letters = np.full(0x110000, -1, np.int32)
        for piece, number in ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = number

    def segment(self, chunk: str, dropout: int, key: int) -> tuple[int, ...]:
        """Piece ids of one chunk. ``dropout``: of 2**64 hash values, those below skip a merge."""
        out: list[int] = []
        for piece in self._merged(chunk, dropout, key):
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            else:
                out.extend(map(self.fallback.__getitem__, piece.encode()))
        return tuple(out)

    def _merged(self, chunk: str, dropout: int, key: int) -> list[str]:
        """The pieces left when the agenda of merges is empty."""
        rank, text, n = self.ranks.get, list(chunk), len(chunk)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, int]] = []

        def propose(left: int, right: int) -> None:
            best = rank(text[left] + text[right])
            if best is not None:
                heapq.heappush(agenda, (best, left, right, right + len(text[right])))

        for k in range(n - 1):
            propose(k, k + 1)
        while agenda:
            _, left, right, end = heapq.heappop(agenda)
            if not text[left] or not text[right] or left + len(text[left]) != right or right + len(text[right]) != end:
                continue
            if dropout and skip_hash(key, left, right, end) < dropout:
                continue
            text[left] += text[right]
            text[right] = ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                propose(left, follow)
            if before[left] >= 0:
                propose(before[left], left)
        return [piece for piece in text if piece]

    def _store_pairs(self, pairs: np.ndarray, makes: np.ndarray) -> None:
        """A table of at most one pair in four places: a pair lies at its hash or in the next places that are free."""
        self.bits = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        size = 1 << (64 - int(self.bits))
        self.pairs, self.makes = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        left, at = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            free = np.flatnonzero(self.pairs[at] == -1)
            first = free[np.unique(at[free], return_index=True)[1]]
            self.pairs[at[first]], self.makes[at[first]] = pairs[left[first]], makes[left[first]]
            left, at = np.delete(left, first), (np.delete(at, first) + 1) % size

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece that each pair of pieces makes, and its rank; no piece has rank NEVER."""
        key = left.astype(np.int64) * self.size + right
        at = self._slot(key)
        held = self.pairs[at]
        rest = np.flatnonzero((held != key) & (held != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.pairs)
            held[rest] = now = self.pairs[at[rest]]
            rest = rest[(now != key[rest]) & (now != -1)]
        makes = self.makes[at]
        return makes, np.where((held == key) & (left >= 0) & (right >= 0), self.rank_of[makes], np.float32(NEVER))

    def segment_all(self, chunks: list[str], dropout: int, keys: np.ndarray) -> list[tuple[int, ...]]:
        """:meth:`segment` of many chunks."""
        pieces, begins = self.agendas(chunks, dropout, keys)[:2]
        numbers, cuts = pieces.tolist(), begins.tolist()
        return [tuple(numbers[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def agendas(
        self, chunks: list[str], dropout: int, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all chunks and where those of each begin, and the merges made, in the same form.

        Chunks of like length are worked off in step: each round takes the best merge of every row that
        has one left. Long chunks are worked off one by one, and their merges are not noted.
        """
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        found: list[tuple] = []
        for low, high in zip((0, *WIDTHS), WIDTHS):
            of_width = np.flatnonzero((sizes > low) & (sizes <= high))
            for a in range(0, len(of_width), STEP):
                rows = of_width[a : a + STEP]
                lengths = sizes[rows]
                codes = np.frombuffer("".join([chunks[r] for r in rows.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
                # A character that is no piece stands as the negative of its number and joins no pair.
                ids = np.full((len(rows), high + 1), -1, np.int32)
                letters = self.letters[codes]
                ids[np.arange(high + 1) < lengths[:, None]] = np.where(letters < 0, -2 - codes.astype(np.int32), letters)
                found.append((rows, *self._in_step(ids, lengths, dropout, keys[rows])))
        for row in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            pieces = np.array(self.segment(chunks[row], dropout, int(keys[row])), np.int32)
            found.append((np.array([row]), pieces, np.array([len(pieces)]), np.zeros(0, np.uint64), np.array([0])))
        return *_in_order(len(chunks), [f[:3] for f in found], np.int32), *_in_order(len(chunks), [(f[0], *f[3:]) for f in found], np.uint64)

    def _in_step(
        self, ids: np.ndarray, lengths: np.ndarray, dropout: int, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n, width = ids.shape
        place = np.arange(width, dtype=np.int64)
        nxt = np.minimum(place + 1, lengths[:, None]).ravel()
        prv = np.tile(place - 1, n)
        alive = (place < lengths[:, None]).ravel()
        makes, ranks = np.zeros((n, width), np.int32), np.full((n, width), NEVER, np.float32)
        first, rank = self._pair(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        makes[:, :-1], ranks[:, :-1] = first.reshape(n, width - 1), rank.reshape(n, width - 1)
        flat_ids, flat_makes, flat_ranks = ids.ravel(), makes.ravel(), ranks.ravel()
        open_, made = np.arange(n), []
        while len(open_):
            k = ranks[open_].argmin(axis=1)
            at = open_ * width + k
            going = flat_ranks[at] < NEVER
            open_, k, at = open_[going], k[going], at[going]
            row = open_ * width
            split = nxt[at]
            end = nxt[row + split]
            who = open_
            if dropout:
                skip = skip_hashes(keys[open_], k, split, end) < np.uint64(dropout)
                flat_ranks[at[skip]] = NEVER
                row, k, at, split, end, who = row[~skip], k[~skip], at[~skip], split[~skip], end[~skip], who[~skip]
            made.append((who, k << 42 | split << 21 | end))
            flat_ids[at] = flat_makes[at]
            nxt[at], prv[row + end] = end, k
            alive[row + split] = False
            flat_ranks[row + split] = NEVER
            # The merged piece with what follows, and what stands before with the merged piece.
            has = prv[at] >= 0
            left = row[has] + prv[at[has]]
            place_ = np.concatenate([at, left])
            flat_makes[place_], flat_ranks[place_] = self._pair(
                flat_ids[place_], np.concatenate([flat_ids[row + end], flat_ids[at[has]]])
            )
        numbers, counts = self._with_bytes(flat_ids[alive], alive.reshape(n, width).sum(axis=1))
        who = np.concatenate([m[0] for m in made]) if made else np.zeros(0, np.int64)
        codes = np.concatenate([m[1] for m in made]) if made else np.zeros(0, np.int64)
        return numbers, counts, codes[np.argsort(who, kind="stable")].astype(np.uint64), np.bincount(who, minlength=n)

    def _with_bytes(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in which characters that are no piece are the pieces of their bytes, and how many each row has."""
        odd = np.flatnonzero(numbers < 0)
        if not len(odd):
            return numbers, counts
        kinds, which = np.unique(numbers[odd], return_inverse=True)
        spelt = [[self.fallback[b] for b in chr(-2 - k).encode("utf-8", "surrogatepass")] for k in kinds.tolist()]
        lens = np.ones(len(numbers), np.int64)
        lens[odd] = np.array([len(x) for x in spelt])[which]
        out, starts = np.repeat(numbers, lens), np.cumsum(lens) - lens
        for kind, pieces in enumerate(spelt):
            at = starts[odd[which == kind]]
            for j, piece in enumerate(pieces):
                out[at + j] = piece
        row = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(row, lens, minlength=len(counts)).astype(np.int64)

    def decode_flat(self, pieces: np.ndarray, begins: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of pieces one after another, and where those of each text begin."""
        sizes = np.diff(self.byte_at)[pieces]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        parts = []
        for a in range(0, len(pieces), 8 * STEP):
            part = pieces[a : a + 8 * STEP]
            parts.append(self.all_bytes[_places(self.byte_at[part], sizes[a : a + 8 * STEP])].tobytes())
        return b"".join(parts), ends[begins]

    def decode(self, ids) -> str:
        """The text of piece ids; the space that encoding puts in front is taken off."""
        text = b"".join(map(self.bytes.__getitem__, ids))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def _in_order(n: int, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values of rows that come in any order, as ``(rows, values, values of each row)``, by row; and where each begins."""
    counts = np.zeros(n, np.int64)
    for rows, _, own in found:
        counts[rows] = own
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(begins[-1], kind)
    for rows, values, own in found:
        out[_places(begins[rows], own)] = values
    return out, begins


def _places(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes of runs that begin at ``begins`` and have ``counts`` entries."""
    return np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)


class Encoder:
    """Encodes texts of a worker and remembers its words as they are merged without skips.

    An occurrence whose hash touches none of the merges of its word has the word's pieces. The others
    are merged anew, each under its own key, many of them in step.
    """

    def __init__(self, model: Model, dropout: float, seed: int, draws: int | None):
        self.model, self.draws = model, draws
        self.below = min(int(dropout * 2**64), 2**64 - 1)
        self.key = int.from_bytes(hashlib.blake2b(str(seed).encode(), digest_size=8).digest())
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.crcs, self.long = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.pieces, self.piece_at = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.merges, self.merge_at = np.zeros(0, np.uint64), np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Merge new words without skips, and remember their pieces and merges."""
        pieces, piece_at, merges, merge_at = self.model.agendas(chunks, 0, np.zeros(len(chunks), np.uint64))
        self.words.update(zip(chunks, range(len(self.words), len(self.words) + len(chunks))))
        self.crcs = np.append(self.crcs, np.fromiter((zlib.crc32(c.encode("utf-8", "surrogatepass")) for c in chunks), np.uint64, len(chunks)))
        self.long = np.append(self.long, np.fromiter((len(c) > WIDTHS[-1] for c in chunks), bool, len(chunks)))
        self.piece_at = np.append(self.piece_at, piece_at[1:] + len(self.pieces))
        self.merge_at = np.append(self.merge_at, merge_at[1:] + len(self.merges))
        self.pieces, self.merges = np.append(self.pieces, pieces), np.append(self.merges, merges)

    def keys(self, chunks: list[str], draws: list[int]) -> np.ndarray:
        """Key of each chunk and draw, from which its merges are hashed."""
        return self._keys(np.array([zlib.crc32(c.encode()) for c in chunks], np.uint64), np.array(draws, np.uint64))

    def _keys(self, own: np.ndarray, draws: np.ndarray) -> np.ndarray:
        return mix(own << np.uint64(32) ^ draws) ^ np.uint64(self.key)

    def draw(self, doc: str, count: int) -> list[int]:
        """Draw of each chunk of a document, by its place."""
        return self._draw(doc, count).tolist()

    def _draw(self, doc: str, count: int) -> np.ndarray:
        if not self.below or self.draws == 1:
            return np.zeros(count, np.uint64)
        own = int.from_bytes(hashlib.blake2b(doc.encode(), digest_size=8).digest()) ^ self.key
        places = mix(np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(own))
        return places if self.draws is None else places % np.uint64(self.draws)

    def encode(self, texts: list[str | None], docs: list[str | None]) -> list[list[int] | None]:
        """Piece ids of each text. ``docs`` keys the draws of its words."""
        pieces, begins = self.encode_flat(texts, docs)
        numbers, cuts = pieces.tolist(), begins.tolist()
        return [None if text is None else numbers[a:b] for text, a, b in zip(texts, cuts[:-1], cuts[1:])]

    def encode_flat(self, texts: list[str | None], docs: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after another, and where those of each text begin."""
        if len(self.words) > REMEMBERED:
            self._forget()
        split = [_CHUNK.findall(f" {text}") if text else [] for text in texts]
        chunks = list(chain.from_iterable(split))
        new = [c for c in dict.fromkeys(chunks) if c not in self.words]
        if new:
            self._learn(new)
        word = np.fromiter(map(self.words.__getitem__, chunks), np.int64, len(chunks))
        sizes = [len(s) for s in split]
        drawn = np.concatenate([np.zeros(0, np.uint64), *[self._draw(doc or "", n) for doc, n in zip(docs, sizes)]])
        keys = self._keys(self.crcs[word], drawn)
        touched = self._touched(word, keys)
        again = self.model.agendas([chunks[k] for k in touched.tolist()], self.below, keys[touched])
        # A word's pieces lie in the memory, those of a word that was merged anew behind it.
        begins, counts = self.piece_at[word], np.diff(self.piece_at)[word]
        begins[touched], counts[touched] = again[1][:-1] + len(self.pieces), np.diff(again[1])
        pieces = np.concatenate([self.pieces, again[0]])[_places(begins, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return pieces, ends[np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])]

    def _touched(self, word: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Occurrences whose key skips a merge of their word; long words are always merged anew."""
        if not self.below:
            return np.zeros(0, np.int64)
        begins, counts = self.merge_at[word], np.diff(self.merge_at)[word]
        hit = self.long[word]
        for a in range(0, len(word), 4 * STEP):
            own = counts[a : a + 4 * STEP]
            merges = self.merges[_places(begins[a : a + 4 * STEP], own)]
            x = (np.repeat(keys[a : a + 4 * STEP], own) ^ merges) * np.uint64(0x9E3779B97F4A7C15)
            skipped = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) < np.uint64(self.below)
            hit[a + np.repeat(np.arange(len(own)), own)[skipped]] = True
        return np.flatnonzero(hit)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        proto = file.read(MODEL_BYTES + 1)
    if len(proto) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return proto


def _transcoder(proto: bytes, dropout: float, seed: int, draws: int | None, ids: bool, decoded: bool, names: tuple[str, str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(proto)
        encoder = Encoder(model, dropout, seed, draws)
        for table in by_bytes(batches, ENCODE_BYTES):
            batch = table.combine_chunks().to_batches()[0] if table.num_rows else None
            if batch is None:
                continue
            texts = batch.column(names[0]).to_pylist()
            pieces, begins = encoder.encode_flat(texts, batch.column(names[1]).to_pylist())
            counts, digests, same, all_ids, back = np.diff(begins), [], [], [], []
            plain, ends = model.decode_flat(pieces, begins)
            for text, a, b, c, d in zip(texts, begins[:-1].tolist(), begins[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                # The space that encoding puts in front is taken off.
                decoded_text = None if text is None else plain[c + (plain[c : c + 1] == b" ") : d]
                digests.append(None if text is None else hashlib.sha256(pieces[a:b]).hexdigest())
                same.append(decoded_text == (None if text is None else text.encode("utf-8", "surrogatepass")))
                if ids:
                    all_ids.append(None if text is None else pieces[a:b])
                if decoded:
                    back.append(None if text is None else decoded_text.decode("utf-8", "replace"))
            columns = {n: batch.column(n) for n in batch.schema.names if n not in names}
            columns |= {"n_pieces": pa.array(counts, pa.int64()), "ids_sha256": pa.array(digests, pa.string()), "lossless": pa.array(same, pa.bool_())}
            if ids:
                columns["piece_ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            if decoded:
                columns["decoded"] = pa.array(back, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def transcode(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL,
    dropout: float = DROPOUT, seed: int = SEED, draws: int | None = DRAWS, ids: bool = True, decoded: bool = False,
) -> DataFrame:
    """Encodes every whole text, decodes the pieces again, and adds to all columns of ``docs``

    ``n_pieces``, ``ids_sha256`` (of the ids as 4-byte little-endian numbers), ``lossless`` (the
    decoded text equals the text), and on request ``piece_ids`` and ``decoded``. The id keys the
    draws, so copies under other ids are cut differently; rows that repeat an id and text are cut
    alike. Null text: 0 pieces, null digest, ids and decoded, lossless. Empty text: no pieces. Any
    character that no piece has, the model's own space sign included, goes as its bytes. Columns of
    the names to add are replaced. A map over the scan's partitions; nothing is shuffled.
    """
    added = [*RESULT]
    if ids:
        added.append(T.StructField("piece_ids", T.ArrayType(T.IntegerType())))
    if decoded:
        added.append(T.StructField("decoded", T.StringType()))
    docs = docs.drop(*[f.name for f in added])
    if not 0 <= dropout <= 1 or (draws is not None and draws < 1):
        raise ValueError("dropout lies between 0 and 1, draws is None or 1 or more")
    small_batches(docs.sparkSession)
    names = free_name(docs, "__text"), free_name(docs, "__doc")
    keyed = docs.select("*", F.col(text_col).cast("string").alias(names[0]), F.col(id_col).cast("string").alias(names[1]))
    return keyed.mapInArrow(
        _transcoder(read_model(model_path), dropout, seed, draws, ids, decoded, names),
        T.StructType([*docs.schema.fields, *added]),
    )
