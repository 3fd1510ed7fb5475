"""Decontamination, pieces, licenses and repeated strings against brute force."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest
import sentencepiece

from tests.llm.cases import DOCS, frame, prose, rows, with_extra
from trendloom.llm import decontamination, licenses, pieces, repeats

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- benchmark decontamination --------------------------------------------------------------


def judged(text, items, window=13):
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for item, other in items:
        other = WORD.findall(lower(other))
        size = min(window, len(other))
        for k in range(len(other) - size + 1 if other else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == other[k : k + size]:
                    hit.update(range(j, j + size))
                    if item is not None:
                        found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


def benchmark_rows():
    data = rows()
    passage = data[20][1].split("\n")[1]
    return [(1, passage), (2, passage.upper() + " more"), (10, "A b, C d"), (3, None), (4, ""), (None, "x" * 700), (5, data[9][1]), (5, data[9][1])]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1, "block_bytes": 1}, {"shard_bytes": 3000, "block_bytes": 900}])
def test_decontamination_against_brute_force(spark, options):
    items = benchmark_rows()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.judge(decontamination.find_benchmark(with_extra(frame(spark)), benchmark, **options)).collect()
    assert len(out) == len(rows())
    for r in out:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == judged(r.text, items), r.doc_id
    passage = items[0][1].split()
    first = next(r for r in out if r.doc_id == 20)
    assert first.found.longest_words >= len(passage)
    assert WORD.findall(lower(first.text))[first.found.longest_at :][: len(passage)] == passage


def test_decontamination_of_empty_tables(spark):
    empty, items = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(empty, items).count() == 0
    wide = with_extra(frame(spark))
    assert decontamination.decontaminate(wide, items).schema == wide.schema
    kept = decontamination.decontaminate(frame(spark), items)
    assert kept.count() == len(rows()) and kept.schema == DOCS


def test_suffix_array_orders_suffixes():
    import numpy as np

    rng = random.Random(3)
    ids = np.array([rng.choice([0, 1, 2]) for _ in range(300)], np.int32)
    key = lambda p: tuple((list(ids[p : p + 13]) + [0] * 13)[:13])
    cut = lambda t: t[: t.index(0)] if 0 in t else t
    got = [cut(key(p)) for p in decontamination.suffix_array(ids, 13)]
    assert got == sorted(got) and len(got) == int((ids > 0).sum())


# ---- pieces ---------------------------------------------------------------------------------


def test_pieces_without_dropout_are_the_library_s(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for r in pieces.transcode(with_extra(frame(spark)), dropout=0, decoded=True).collect():
        assert r.lossless and r.decoded == r.text
        if r.text and "▁" not in r.text:
            assert r.piece_ids == lib.encode(r.text) and lib.decode(r.piece_ids) == r.text


def test_merge_dropout_varies_and_repeats(spark):
    docs = frame(spark)
    ids = lambda **o: {(r.doc_id, r.text): r.piece_ids for r in pieces.transcode(docs, **o).collect()}
    one, same, other, hard = ids(), ids(), ids(seed=7), ids(dropout=1.0)
    assert one == same and one != other
    assert one[9, rows()[9][1]] != one[12, rows()[12][1]]  # equal texts, other ids
    assert len(hard[3, "word"]) == 5  # every merge skipped: a space and four letters
    assert all(r.lossless for o in ({}, {"dropout": 0.5}, {"draws": 1}) for r in pieces.transcode(docs, **o).collect())
    null = next(r for r in pieces.transcode(docs).collect() if r.doc_id == 0)
    assert (null.n_pieces, null.ids_sha256, null.piece_ids, null.lossless) == (0, None, None, True)
    assert pieces.transcode(frame(spark, [])).count() == 0
    assert pieces.transcode(with_extra(docs)).filter("n_pieces >= 0").count() == len(rows())


def test_agendas_in_step_equal_single_ones(monkeypatch):
    model = pieces.Model(pieces.read_model(pieces.MODEL))
    rng = random.Random(1)
    text = prose(rng, 300) + " The international unbelievable ÜBERSETZUNG 12345,67 " + "".join(rng.choice("abei ▁\n😀") for _ in range(400)) + " " + "the" * 40
    for dropout in (0, 0.3, 1.0):
        encoder = pieces.Encoder(model, dropout, 1, 4)
        chunks = pieces._CHUNK.findall(f" {text}")
        drawn = encoder.draw("7", len(chunks))
        keys = encoder.keys(chunks, drawn)
        single = [model.segment(c, encoder.below, int(k)) for c, k in zip(chunks, keys)]
        assert model.segment_all(chunks, encoder.below, keys) == single
        want = [k for ids in single for k in ids]
        assert encoder.encode([text, None, ""], ["7", "8", None]) == [want, None, []] and model.decode(want) == text
        monkeypatch.setattr(pieces, "REMEMBERED", 3)
        monkeypatch.setattr(pieces, "STEP", 5)
        small = pieces.Encoder(model, dropout, 1, 4)
        assert small.encode(["a b c"], ["1"]) and small.encode([text], ["7"]) == [want]


def naive_pieces(model, chunk, below, key):
    """Looks at all neighbours in every step and takes the best pair that no hash has skipped."""
    parts, skipped, start = list(chunk), set(), 0
    while True:
        spans, start = [], 0
        for part in parts:
            spans.append((start, start + len(part)))
            start += len(part)
        found = [
            (model.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            if a + b in model.ranks and (spans[i][0], spans[i][1], spans[i + 1][1]) not in skipped
        ]
        if not found:
            return tuple(k for p in parts for k in ([model.ids[p]] if p in model.ids else [model.fallback[b] for b in p.encode()]))
        i = min(found)[1]
        place = (spans[i][0], spans[i][1], spans[i + 1][1])
        if pieces.skip_hash(key, *place) < below:
            skipped.add(place)
        else:
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("dropout", [0, 0.1, 0.4, 1.0])
def test_pieces_equal_those_of_a_naive_agenda(dropout):
    model = pieces.Model(pieces.read_model(pieces.MODEL))
    rng = random.Random(9)
    words = ["international", "unbelievable", "ÜBERSETZUNG", "12345,67", "日本語の", "😀▁x", "a" * 31, "b" * 40, "ab\tcd", ""]
    text = " ".join(rng.choice([*words, prose(rng, 1), prose(rng, 1)]) for _ in range(400))
    encoder = pieces.Encoder(model, dropout, 5, None)
    chunks = pieces._CHUNK.findall(f" {text}")
    keys = encoder.keys(chunks, encoder.draw("d", len(chunks)))
    want = [k for c, key in zip(chunks, keys.tolist()) for k in naive_pieces(model, c, encoder.below, key)]
    assert encoder.encode([text], ["d"]) == [want] and model.decode(want) == text


def test_pieces_of_long_texts_and_of_a_chunk_without_spaces(spark):
    rng = random.Random(3)
    long = prose(rng, 900_000)  # over 4 MB
    solid = "".join(rng.choice("abcdefghij日é") for _ in range(60_000))
    docs = spark.createDataFrame([(1, long, None, None, 0), (2, solid, None, None, 0), (3, " " * 5000 + "▁" * 300, None, None, 0)], DOCS)
    got = {r.doc_id: r for r in pieces.transcode(docs).collect()}
    assert all(r.lossless and r.n_pieces == len(r.piece_ids) > 300 for r in got.values())
    model = pieces.Model(pieces.read_model(pieces.MODEL))
    assert model.decode(got[2].piece_ids) == solid


def test_each_occurrence_draws_for_itself():
    """Every word of one merge is skipped in about a tenth of its occurrences, not in k of 16 ways."""
    model = pieces.Model(pieces.read_model(pieces.MODEL))
    encoder = pieces.Encoder(model, 0.1, 42, pieces.DRAWS)
    merges = lambda w: int(model.agendas([w], 0, np.zeros(1, np.uint64))[3][-1])
    single = [w for w in model.ids if len(w) == 2 and w[0] == " " and w[1].isalpha() and merges(w) == 1][:40]
    assert len(single) == 40
    for word in single:
        ids = encoder.encode([(word * 3000)[1:]], ["1"])[0]
        assert 0.07 < len(ids) / 3000 - 1 < 0.13
    # All draws of a longer word equal those of its agenda with the key of the occurrence.
    text = " unbelievable" * 500
    drawn = encoder.draw("2", 500)
    keys = encoder.keys([" unbelievable"] * 500, drawn)
    assert len(set(drawn)) == 500
    assert encoder.encode([text[1:]], ["2"]) == [[i for k in keys for i in model.segment(" unbelievable", encoder.below, int(k))]]


# ---- licenses -------------------------------------------------------------------------------


def test_license_scan(spark):
    from trendloom.llm.license_texts import ISC, MIT, ZLIB

    mit = "Copyright (c) 2020 A. Person\nAll Rights Reserved.\n\n" + MIT.replace("sublicense", "sub-licence").replace('"', "“", 1).upper()
    data = [
        (1, mit), (2, MIT + "and more"), (3, None), (4, ""), (5, "© 1999 nobody"), (6, "Some text\n  licensed under CC-BY-NC 4.0 \nRELEASED under the MIT licence!"),
        (6, "other"), (7, ZLIB.replace("acknowledgment", "acknowledgement")), (8, ISC), (None, "Licensed under the Apache License, version v2.0"), (9, "x" * 200_000),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r.doc_id, r.license_id, r.statements) for r in licenses.document_licenses(with_extra(docs)).collect()}
    assert got == {
        (1, "MIT", None), (2, None, None), (3, None, None), (4, None, None), (5, None, None), (6, None, "CC-BY-NC-4.0,MIT"),
        (7, "Zlib", None), (8, None, None), (None, "Apache-2.0", "Apache-2.0"), (9, None, None),
    }
    assert licenses.document_licenses(docs.limit(0)).count() == 0
    empty = {r.canonical_sha256 for r in licenses.license_scan(docs).filter("doc_id in (3, 4, 5)").collect()}
    assert empty == {hashlib.sha256(b"").hexdigest()}


COMMON = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.exists(f"{COMMON}/GPL-3"), reason="no folder of licenses")
def test_whole_licenses_from_a_folder(spark, folder):
    """Long texts, re-wrapped and re-spelled, are found in full; an addition makes another text."""
    known = licenses.texts_in(spark, f"{COMMON}/[A-Z]*-[0-9]*")
    ids = {r.license_id for r in known.collect()}
    assert {"GPL-3", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "Apache-2.0"} <= ids
    text = {name: open(f"{COMMON}/{name}", encoding="utf-8").read() for name in ("GPL-3", "MPL-2.0", "Apache-2.0")}
    rows = [
        (1, "Copyright (c) 2021 A. Person\n" + text["GPL-3"]), (2, text["MPL-2.0"].upper().replace("\n", "\r\n  ")),
        (3, text["Apache-2.0"].replace("License", "Licence")), (4, text["GPL-3"] + " and more"), (5, None), (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.document_licenses(with_extra(docs), known=known).collect()}
    assert got == {1: "GPL-3", 2: "MPL-2.0", 3: "Apache-2.0", 4: None, 5: None, 6: None}
    assert licenses.document_licenses(docs, known=known.limit(0)).filter("license_id is not null").count() == 0


def test_known_texts_without_words_are_no_licenses(spark):
    known = spark.createDataFrame([("x", None), ("y", "Copyright nobody"), ("a", "Be Good."), ("b", "be good")], "license_id string, text string")
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "Be good!"), (3, "Be good!")], "doc_id long, text string")
    got = sorted((r.doc_id, r.license_id) for r in licenses.license_scan(docs, known=known).collect())
    assert got == [(1, None), (2, None), (3, "a|b"), (3, "a|b")]


# ---- repeated strings -----------------------------------------------------------------------


def without_repeats(data, length):
    seen = collections.Counter()
    raws = [(t or "").encode() for _, t, *_ in data]
    for raw in raws:
        seen.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    for raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = [[m.start(), m.end()] for m in re.finditer(b"\1+", bytes(gone))]
        yield len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)


@pytest.mark.parametrize(("length", "kmer", "most"), [(200, 64, 256), (40, 12, 256), (40, 12, 2), (25, 25, 1)])
def test_repeats_against_brute_force(spark, length, kmer, most):
    data = rows()
    want = collections.Counter((r[0], n, g, str(s), k) for r, (n, g, s, k) in zip(data, without_repeats(data, length)))
    out = repeats.remove_repeats(with_extra(frame(spark)), length=length, kmer=kmer, most=most, shard_bytes=2000).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, str(r.removed), bytes(r.kept)) for r in out) == want
    assert repeats.remove_repeats(frame(spark, []), length=length, kmer=kmer).count() == 0


def test_places_are_looked_for_once(spark, monkeypatch):
    seen, placer = spark.sparkContext.accumulator(0), repeats._placer

    def counted(length, kmer):
        def run(batches):
            def told():
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            return placer(length, kmer)(told())

        return run

    monkeypatch.setattr(repeats, "_placer", counted)
    docs = spark.createDataFrame([(k, f"{k} these words stand in each of the texts") for k in range(30)], "doc_id long, text string")
    assert {r.n_removed > 0 for r in repeats.remove_repeats(docs, length=20, kmer=6).collect()} == {True}
    assert seen.value == 30


def test_every_removed_byte_comes_from_the_index(spark, monkeypatch):
    data = [(1, "one passage that stands in three texts"), (2, "one passage that stands in three texts"), (3, "in front one passage that stands in three texts behind")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs, length=20, kmer=6).collect()} == {1: 38, 2: 38, 3: 38}
    monkeypatch.setattr(repeats, "repeated_spans", lambda contexts, copies, length: [[] for _ in contexts])
    assert {r.n_removed for r in repeats.remove_repeats(docs, length=20, kmer=6).collect()} == {0}


def test_suffix_order_of_repeated_text():
    for text in ([0], [5] * 40, [1, 2, 0] * 30, [1, 2, 3, 4, 5, 6, 7, 8, 9, 0] * 9, [3, 256] * 25):
        # A 0 sorts below all symbols and an earlier 0 below a later one; so does the end.
        ends = [*[(0, p) if c == 0 else (1, c) for p, c in enumerate(text)], (0, len(text))]
        assert repeats.suffix_order(np.array(text, np.int16)).tolist() == sorted(range(len(text)), key=lambda p: ends[p:])


def test_contexts_given_twice():
    contexts, copies = [b"abcdefgh", b"xbcdefgy", b"qrstuvw", b"nothing", b"\0\xff\0\xff\0", b"trstuvw"], np.array([2, 1, 2, 1, 2, 2])
    text = repeats.joined([c for c, n in zip(contexts, copies) for _ in range(n)])
    assert repeats.twofold_order(contexts, copies).tolist() == repeats.suffix_order(text).tolist()
    assert repeats.repeated_spans(contexts, copies, 5) == [[[0, 8]], [[1, 7]], [[0, 7]], [], [[0, 5]], [[0, 7]]]


def test_index_of_different_contexts_is_small_in_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    common = rng.integers(97, 123, 64, np.uint8).tobytes()
    contexts = [rng.integers(97, 123, 136, np.uint8).tobytes() + common + rng.integers(97, 123, 136, np.uint8).tobytes() for _ in range(600)]
    tracemalloc.start()
    assert not any(repeats.repeated_spans(contexts, np.ones(len(contexts), np.int64), 200))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * sum(map(len, contexts))  # it was 250 bytes for each byte of text


def test_run_index_finds_longest_matches():
    import numpy as np

    rng = random.Random(2)
    for size in (1, 2, 7, 60):
        text = np.array([rng.choice([1, 2, 3]) for _ in range(size)], np.int16)
        best = repeats.RunIndex(text).matching(1000)
        for p in range(size):
            longest = 0
            for q in range(size):
                k = 0
                while q != p and max(p, q) + k < size and text[p + k] == text[q + k]:
                    k += 1
                longest = max(longest, k)
            assert best[p] == longest
