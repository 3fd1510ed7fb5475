"""Exact and near dedup, urls, archives, language model and classifier."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import DOCS, frame, prose, rows, with_extra
from trendloom.llm import bloom_lm, components, exact_dedup, hashing, near_dedup, quality, shared, urls, warc


# ---- words ----------------------------------------------------------------------------------


@pytest.mark.parametrize("step", [5, 40, 1 << 20])
def test_word_hashes(monkeypatch, step):
    monkeypatch.setattr(hashing, "STEP", step)
    rng, known = random.Random(1), {}
    for _ in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("aB \n\tÄé") for _ in range(rng.choice([0, 3, 30]))) for _ in range(rng.choice([0, 1, 9]))]
        hashes, offsets = hashing.word_hashes(pa.array(texts, pa.string()), hashing.Powers())
        words = [w for t in texts for w in shared.words(t)]
        assert np.diff(offsets).tolist() == [len(shared.words(t)) for t in texts] and len(hashes) == len(words)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes.tolist()))
    assert len(set(known.values())) == len(known)


# ---- exact dedup ----------------------------------------------------------------------------


@pytest.mark.parametrize("old", ["doc_id < 20", "false", "true", "doc_id is null"])
def test_exact_dedup_against_brute_force(spark, old):
    import pyspark.sql.functions as F

    out = exact_dedup.exact_dedup(with_extra(frame(spark)), F.expr(old), shard_keys=3).collect()
    groups = collections.defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    is_old = {"false": lambda i: False, "true": lambda i: True, "doc_id < 20": lambda i: i is not None and i < 20, "doc_id is null": lambda i: i is None}[old]
    for i, t, *_ in rows():
        groups[norm(t)].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        first = [i for i in ids if is_old(i)] or ids
        keep = min((i for i in first if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out) == want


def test_exact_dedup_drops_and_takes_empty_tables(spark):
    docs = frame(spark)
    kept = exact_dedup.drop_repeats(docs, exact_dedup.early_half(docs))
    assert kept.schema == DOCS and kept.filter("text is null or text = ''").count() == 1  # null and '' are equal
    empty = frame(spark, [])
    assert exact_dedup.drop_repeats(empty, exact_dedup.early_half(empty)).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    keys[7] = keys[8]  # equal first 64 bits of two digests
    sizes, bits, slots = exact_dedup.build_hash(keys)
    assert sorted(slots.tolist()) == list(range(5000)) and bits.sum() == 4998
    alone = np.ones(5000, bool)
    alone[[7, 8]] = False
    assert (exact_dedup.find_slots(keys[alone], sizes, bits) == slots[alone]).all()
    assert exact_dedup.build_hash(keys[:0])[0] == []


# ---- near dedup -----------------------------------------------------------------------------


def near_brute(data, size=5):
    sets = []
    for i, t, *_ in data:
        words = shared.words(t)
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())
    ids = [r[0] for r in data]
    group = {i: i for i in ids if i is not None}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if None not in (ids[a], ids[b]) and sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(ids[a]), root(ids[b])))
                group[high] = low
    return collections.Counter((i, len(s), None if i is None else root(i)) for i, s in zip(ids, sets))


@pytest.mark.parametrize("block", [512, 2])
def test_near_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    out = near_dedup.near_groups(with_extra(frame(spark))).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == near_brute(rows())
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_groups_of_test_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_dedup.near_groups(docs).collect()
    want = near_brute([(r.doc_id, r.text) for r in docs.collect()])
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == want


def test_second_pass_links_what_stars_miss(spark):
    """Chains in one bucket: neighbours are similar, the ends are not."""
    words = [f"w{k}" for k in range(300)]
    data = [(k, " ".join(words[10 * k : 10 * k + 100]), None, None, None) for k in range(12)]
    out = near_dedup.near_groups(frame(spark, data)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == near_brute(data)
    assert near_dedup.near_groups(frame(spark, [])).count() == 0
    wide = with_extra(frame(spark))
    assert near_dedup.drop_near_copies(wide).schema == wide.schema
    assert exact_dedup.drop_repeats(wide, exact_dedup.early_half(wide)).schema == wide.schema


def test_min_max_signature_is_unbiased():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[200:])
    signs = near_dedup.signature([a, b], 400)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signs[0] == signs[1]).mean() - true) < 0.06


def test_components(spark):
    links = [(1, 2), (3, 2), (3, 4), (5, 4), (9, 8), (7, 7), (None, 4), (10, 8), (10, 9)] + [(100 + k, 101 + k) for k in range(40)]
    got = dict(components.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {2: 1, 3: 1, 4: 1, 5: 1, 9: 8, 10: 8} | {101 + k: 100 for k in range(40)}


# ---- urls -----------------------------------------------------------------------------------


def test_url_rules_and_parts(spark):
    data = [
        (1, "http://WWW.Example.com/en/1"), (2, "https://example.com/en/"), (3, "http://a.example.com/de/?x#y"), (4, "x://b.net/es/1"), (5, "x://b.net"),
        (6, None), (7, "no scheme/en"), (8, ""), (9, "http://badexample.com/en/1"), (10, "http://net/fr/"), (11, "a://b://c?d"), (11, "a://b://c?d"), (None, "http://h.org/" + "s/" * 2000),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = urls.filter_urls(with_extra(pages), labels).collect()
    got = collections.Counter((r.page_id, r.host, r.path[:12], r.rule, r.verdict) for r in out)
    assert got == collections.Counter([
        (1, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (2, "example.com", "/en/", "example.com/en/", "block"),
        (3, "a.example.com", "/de/", "com/", "allow"), (4, "b.net", "/es/1", "net/es/", "block"), (5, "b.net", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "badexample.com", "/en/1", "com/", "allow"),
        (10, "net", "/fr/", "net/fr/", "block"), (11, "b:", "//c", None, "allow"), (11, "b:", "//c", None, "allow"), (None, "h.org", "/s/s/s/s/s/s", None, "allow"),
    ])
    assert urls.filter_urls(pages.limit(0), labels).count() == 0


def test_url_templates_split_by_labels(spark):
    """The bad branch stands alone and is blocked; the others, alike, merge."""
    data, told = [], []
    for k in range(600):
        branch = ("spam", "news", "blog")[k % 3]
        data.append((k, f"http://x.org/{branch}/{k}/a{k}"))
        told.append((k, int(branch != "spam" or k % 10 == 0), 0))
    told += [(5, 1, 0), (6, None, 0), (None, 0, 0)]
    pages, labels = spark.createDataFrame(data, "page_id long, url string"), spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    out = collections.Counter((r.template, r.verdict) for r in urls.filter_urls(pages, labels).collect())
    assert out == {("/spam/*/*", "block"): 200, ("/{blog|news}/*/*", "allow"): 400}


def test_a_chain_of_small_steps_keeps_good_and_bad_apart(spark):
    data, told = [], []
    for section in range(21):  # rates of bad labels 0, 0.05 ... 1
        for k in range(40):
            page = section * 40 + k
            data.append((page, f"http://h.org/s{chr(97 + section)}/{page}"))
            told.append((page, 0 if k < 2 * section else 1, 0))
    for k in range(60):  # segments that look like a wildcard
        data += [(2000 + k, f"http://w.org/*/{k}"), (3000 + k, f"http://w.org/{k}/{k}"), (4000 + k, f"http://w.org/{{a|b}}/x")]
        told += [(2000 + k, 0, 0), (3000 + k, 1, 0), (4000 + k, 1, 0)]
    pages, labels = spark.createDataFrame(data, "page_id long, url string"), spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    out = {r.page_id: r for r in urls.filter_urls(pages, labels).collect()}
    verdicts = [out[section * 40].verdict for section in range(21)]
    assert verdicts == sorted(verdicts) and verdicts[0] == "allow" and verdicts[-1] == "block"
    templates = [out[section * 40].template for section in range(21)]
    assert len(set(templates)) >= 3 and out[0].purity > 0.85 > 0.3 > out[800].purity
    assert {out[2000 + k].verdict for k in range(60)} == {"block"} and out[2000].template == "/%2A/*"
    assert {out[3000 + k].verdict for k in range(60)} == {out[4000 + k].verdict for k in range(60)} == {"allow"}


def test_url_templates_go_by_labels_not_by_share_or_depth(spark):
    """A bad section among 25, with 4 % of the visits, and a bad folder in the fifth level are told apart."""
    data, told = [], []
    for k in range(1000):
        data.append((k, f"http://x.org/part{'abcdefghijklmnopqrstuvwxy'[k % 25]}/{k}"))
        told.append((k, int(k % 25 != 7), 0))
    for k in range(1000, 1400):
        data.append((k, f"http://y.org/a/b/c/d/{('good', 'spam')[k % 2]}/{k}"))
        told.append((k, 1 - k % 2, 0))
    pages, labels = spark.createDataFrame(data, "page_id long, url string"), spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    out = urls.filter_urls(pages, labels).collect()
    assert len(out) == 1400 and {r.page_id for r in out if r.verdict == "block"} == {k for k, good, _ in told if not good}
    assert {r.template for r in out if r.host == "y.org"} == {"/a/b/c/d/good/**", "/a/b/c/d/spam/**"}


# ---- archives -------------------------------------------------------------------------------


@pytest.mark.parametrize("minimum", [0, 5])
def test_archive_and_read(spark, minimum):
    data = [
        (1, "http://a.example/x", "same"), (2, "http://b.example/y", "same"), (3, None, None), (4, "http://a.example/x", ""), (5, "odd \r\n url", "long enough"),
        (6, "http://a.example/x", "long enough"), (6, "http://a.example/x", "long enough"), (None, "http://n.example", "no id"), (None, "http://n.example", "long enough"), (7, "http://b.example/", "é" * 90_000),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    out = warc.archive_and_read(with_extra(pages), min_bytes=minimum, file_bytes=300).collect()
    want = collections.Counter()
    for i, _, html in data:
        raw = (html or "").encode()
        best = max((j for j, _, h in data if (h or "") == (html or "") and j is not None), default=None)
        again = len(raw) >= minimum and best is not None and best != i
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", best if again else None] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert warc.archive_and_read(pages.limit(0)).count() == 0


@pytest.mark.parametrize("given, named", [
    ("s3a://bucket/a b/c", "s3://bucket/a b/c"), ("s3://bucket/a", "s3://bucket/a"), ("gs://bucket/a", "gs://bucket/a"),
    ("hdfs://name:8020/a", "hdfs://name:8020/a"), ("dbfs:/a/b", "/dbfs/a/b"), ("file:/a/b", "/a/b"), ("file:///a/b", "/a/b"),
    ("/a/b:c", "/a/b:c"), ("wasbs://box@name.blob.core.windows.net/a", "abfss://box@name.dfs.core.windows.net/a"),
])
def test_folders_are_opened_by_any_name(given, named):
    assert warc.arrow_uri(given) == named


def test_index_blocks_and_range_reads(spark, folder):
    data = [(k, f"http://h{k % 7}.example/{k // 3}", f"page {k}") for k in range(500)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    captures = warc.write_archive(pages, f"file:{folder}/archive")
    files = warc.write_index(captures, f"file:{folder}/index", block_lines=7, file_lines=90)
    assert len(files) > 2
    got = warc.look_up(captures, f"file:{folder}/archive", f"file:{folder}/index", files).collect()
    assert {(r.page_id, r.url, r.html) for r in got} == set(data)
    absent = spark.createDataFrame([("zzz",), ("",), ("example,h1)/9 99999",)], "key string")
    assert warc.look_up(absent, f"file:{folder}/archive", f"file:{folder}/index", files).count() == 0


# ---- language model ---------------------------------------------------------------------------


def lm_brute(data):
    tokens = {k: [*shared.words(t), None] for k, (_, t, *_) in enumerate(data)}
    held = {k: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for k, r in enumerate(data)}
    counts = collections.Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    pairs = collections.Counter(p for k, ws in tokens.items() if not held[k] for p in zip(["^", *ws], ws))
    firsts = collections.Counter()
    for (v, _), n in pairs.items():
        firsts[v] += n
    total, kinds = sum(counts.values()), len(counts)
    level = lambda c: (3 * 2 ** math.floor(math.log2(c)) - 1) / 2 if c else 0.0
    for k, ws in tokens.items():
        base = [(counts[w] + 0.1) / (total + 0.1 * (kinds + 1)) for w in ws]
        full = []
        for p, v, w in zip(base, ["^", *ws], ws):
            seen = level(firsts[v])
            full.append((min(level(pairs[v, w]), seen) + bloom_lm.PSEUDO * p) / (seen + bloom_lm.PSEUDO))
        yield data[k][0], held[k], len(ws), sum(counts[w] > 0 for w in ws), total, sum(map(math.log10, base)), sum(map(math.log10, full))


@pytest.mark.parametrize("slice_bytes", [1 << 28, 15_000])
def test_lm_against_exact_counts(spark, slice_bytes):
    out = bloom_lm.learn_and_score(with_extra(frame(spark)), slice_bytes=slice_bytes, segment_bytes=4000).collect()
    assert len(out) == len(rows())
    want = sorted(lm_brute(rows()), key=str)
    got = sorted(((r.doc_id, r.held_out, r.lm.n_tokens, r.lm.n_known, r.train_tokens, r.lm.base_score, r.lm.score) for r in out), key=str)
    for mine, exact in zip(got, want):
        assert mine[:5] == exact[:5] and mine[5] == pytest.approx(exact[5], abs=1e-6)
        assert mine[6] == pytest.approx(exact[6], rel=0.02, abs=0.5)  # the filter errs now and then
    empty = frame(spark, [])
    assert bloom_lm.learn_and_score(empty).count() == 0
    model, layout = bloom_lm.train(empty)
    assert {r.lm.base_score for r in bloom_lm.score(frame(spark), model, layout).collect()} == {0.0}


def test_lm_reads_texts_equally_often_at_any_size(spark, monkeypatch):
    """The plan does not grow with the model: no pass per pair of slices, and nothing is broadcast."""
    def steps(**options):
        df = bloom_lm.learn_and_score(frame(spark), **options)
        return df._jdf.queryExecution().analyzed().toString().count("InArrow")

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", None)
    assert steps() == steps(slice_bytes=400) == 3
    # More text than was learned from is answered by several copies of the model.
    monkeypatch.setattr(bloom_lm, "MEET_BYTES", 2000)
    model, layout = bloom_lm.train(frame(spark, rows()[:15]), slice_bytes=500, segment_bytes=300)
    scores = lambda **o: sorted(((r.doc_id, r.text, r.lm) for r in bloom_lm.score(frame(spark), model, layout, **o).collect()), key=str)
    many = scores(shard_bytes=1000)
    monkeypatch.setattr(bloom_lm, "MEET_BYTES", 1 << 30)
    one = scores()
    assert [x[:2] for x in many] == [x[:2] for x in one]
    for (*_, a), (*_, b) in zip(many, one):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_lm_orders(spark):
    docs = frame(spark)
    for order in (1, 3):
        out = bloom_lm.learn_and_score(docs, order=order).collect()
        assert all(r.lm.score <= 0 and (order > 1 or r.lm.score == r.lm.base_score) for r in out)


def test_filter_levels():
    layout = bloom_lm.Layout(100, 2, 1 << 20, 1 << 20)
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    counts = rng.integers(1, 300, 2000)
    short, _ = bloom_lm._short(keys[:2000], 1)
    raw = lambda k: k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : bloom_lm.GRAM_WIDTH].tobytes()
    packed = pa.table({"once": [b""], "more": [raw(short)], "counts": [counts.astype("<i8").tobytes()]})
    part = bloom_lm._build(tuple(pa.scalar(k) for k in (bloom_lm.GRAMS, 0, 0)), packed)
    held = (np.frombuffer(bytes(8) + part["keys"][0].as_py(), np.uint8), np.array([64]), np.array([part["size"][0].as_py()], np.uint64))
    assert layout.gram_segments == 1
    got = bloom_lm.count_grams(held, keys)
    exact = (3 * 2 ** np.floor(np.log2(counts)) - 1) / 2
    assert (got[:2000] >= exact).all() and (got[:2000] == exact).mean() > 0.98 and (got[2000:] > 0).mean() < 0.03


@pytest.mark.parametrize("width", [bloom_lm.GRAM_WIDTH, 8])
def test_rising_keys_travel_in_a_byte_less(width):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 300, 20_000):
        keys = np.sort(rng.integers(0, 2 ** (8 * width) - 1, n, dtype=np.uint64, endpoint=True))
        keys[: n // 3] = keys[0] if n else 0  # equal keys, too
        sent = bloom_lm.tight(keys, width)
        assert bloom_lm.loose(sent, width) == keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
        assert len(sent) <= n * (width - 1) + n // 8 + 38


def test_counted_keys_are_sent_tight():
    docs = pa.table({"__text": [" ".join(f"{k}.{j}" for j in range(100)) for k in range(50)]})
    rows = [r for b in bloom_lm._counter(bloom_lm.Layout(1000, 2, 1 << 20, 1 << 20), 1 << 20)(iter(docs.to_batches())) for r in b.to_pylist()]
    sent = sum(len(r["once"]) + len(r["more"]) for r in rows if r["kind"] == bloom_lm.GRAMS)
    assert sent < 5.3 * (50 * 101 + 50 * 100 + 1)  # pairs with the end of each text, and what they begin with


# ---- quality --------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels, pages = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "pages"))
    known = labels.filter("pmod(doc_id, 2) = 0")
    out = quality.score_quality(docs, known, pages).join(labels.filter("pmod(doc_id, 2) = 1"), "doc_id").collect()
    assert sum(r.accepted == bool(r.quality) for r in out) / len(out) > 0.95
    good = [r for r in out if r.quality]
    assert sum(not r.accepted for r in good) <= 0.01 * len(good) and all(0 <= r.score <= 1 for r in out)


def test_sample_reaches_the_driver_as_a_bounded_table(spark):
    import pyspark.sql.functions as F

    view = lambda n, c: F.array(*[(F.col("id") % (k + 2) + c).cast("float") for k in range(n)])
    rows_ = spark.range(0, 20_000, 1, 200).select(
        "id", (F.col("id") % 2).cast("int").alias("label"), view(quality.TEXT_FEATURES, 0).alias("text_view"), view(quality.META_FEATURES, 1).alias("meta_view"))
    hot = rows_.filter("id = 7").crossJoin(spark.range(3000).select(F.lit(1))).select(*rows_.columns)  # an id that holds many rows
    near = quality._candidates(rows_.unionAll(hot), 300)
    assert 300 <= near.count() <= 300 + 16 * 300**0.5 + 32  # of 200 tasks together, not each
    picked = quality._sample(rows_.unionAll(hot), 300)[2]
    want = rows_.withColumn("hash", quality._hash()).orderBy("hash", "id").limit(300).collect()
    assert [r.id for r in picked] == [r.id for r in want]
    assert len(quality._sample(rows_.limit(50), 300)[2]) == 50 and quality._sample(rows_.limit(0), 300)[2] == []


@pytest.mark.parametrize("labelled", [quality.LABELLED, 60])
def test_quality_query_equals_co_training_in_memory(spark, sf_dir, labelled):
    docs, labels, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    told, urls_ = {r.doc_id: r.quality for r in labels.collect()}, {r.page_id: r.url for r in pages.collect()}
    hashes = {r.id: r.h for r in docs.selectExpr("doc_id as id").select("id", quality._hash().alias("h")).collect()}
    data = docs.collect()
    text = np.array([quality.text_features(r.text) for r in data], "f4").astype(float)
    meta = np.array([quality.meta_features(r.lang, r.source, r.n_chars, urls_.get(r.doc_id)) for r in data], "f4").astype(float)
    known = sorted((k for k, r in enumerate(data) if r.doc_id in told), key=lambda k: hashes[data[k].doc_id])[:labelled]
    rest = sorted(set(range(len(data))) - set(known))
    assert labelled > 60 or len(known) == 60 < len(told)
    y = np.array([told[data[k].doc_id] for k in known], float)
    aside = np.array([zlib.crc32(f"aside {data[k].doc_id}".encode()) % quality.ASIDE == 0 for k in known], bool)
    judge = quality.co_train(text[known], meta[known], y, aside, text[rest], meta[rest])
    want = dict(zip([r.doc_id for r in data], zip(*judge.score(text, meta))))
    got = {r.doc_id: (r.score, r.text_score, r.meta_score) for r in quality.score_quality(docs, labels, pages, labelled=labelled).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)


def test_quality_odd_tables(spark):
    docs = frame(spark)
    labels, pages = spark.createDataFrame([(9, 1, 0), (9, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int"), spark.createDataFrame([(1, None), (None, "http://x/")], "page_id long, url string")
    out = quality.score_quality(with_extra(docs), labels, pages).collect()
    assert len(out) == len(rows()) and all(r.accepted and r.score == 1 for r in out)  # one kind of label only
    assert quality.score_quality(docs.limit(0), labels, pages).count() == 0
    assert quality.drop_rejected(docs, labels.limit(0), pages).schema == DOCS
    wide = with_extra(docs)
    assert quality.drop_rejected(wide, labels, pages).schema == wide.schema


def test_views_exchange_labels():
    """A view without labels of its own kind learns from the other's sure pseudo-labels."""
    rng = np.random.default_rng(1)
    make = lambda n: ((y := (rng.random(n) < 0.7).astype(float)), np.column_stack([y * 4 + rng.normal(size=n), rng.normal(size=n)]), np.column_stack([y * 3 + rng.normal(size=n), rng.normal(size=n)]))
    y, one, two = make(60)
    _, pool_one, pool_two = make(3000)
    aside = np.arange(60) % 3 == 0
    judge = quality.co_train(one, two, y, aside, pool_one, pool_two)
    test_y, a, b = make(2000)
    scores, _, second = judge.score(a, b)
    assert ((scores > 0.5) == test_y).mean() > 0.95 and ((second > 0.5) == test_y).mean() > 0.9


def test_views_learn_from_all_unlabelled_rows():
    """A kind of 1 row in 600, of which only the first view knows, is taught however long the pool."""
    rng = np.random.default_rng(3)

    def make(n, rare):
        y = (rng.random(n) < 0.7).astype(float)
        kind = np.full(n, float(rare)) if np.isscalar(rare) else rare
        y = np.where(kind > 0, 0.0, y)
        second = np.where(kind > 0, 3.0, y * 3)  # by its other features the rare kind looks good
        return y, np.column_stack([y * 6 + rng.normal(size=n), rng.normal(size=n)]), np.column_stack([second + rng.normal(size=n), kind])

    y, one, two = make(600, 0)
    _, pool_one, pool_two = make(60_000, (np.arange(60_000) % 600 == 0).astype(float))
    order = np.argsort(pool_two[:, 1], kind="stable")  # the rare kind stands behind the 12,000 first
    judge = quality.co_train(one, two, y, np.arange(600) % 4 == 0, pool_one[order], pool_two[order])
    _, _, second = judge.score(*make(300, 1)[1:])
    assert (second < 0.5).mean() > 0.9


def test_sums_over_tables_equal_those_in_memory(spark):
    rng = np.random.default_rng(4)
    text, meta = rng.normal(size=(700, quality.TEXT_FEATURES)).astype("f4"), rng.normal(size=(700, quality.META_FEATURES)).astype("f4")
    table = spark.createDataFrame([(t.tolist(), m.tolist()) for t, m in zip(text, meta)], "text_view array<float>, meta_view array<float>").repartition(40)
    want = quality._moments(text.astype(float), meta.astype(float))
    assert quality._summed(table, quality._moments) == pytest.approx(want)
    assert (quality._summed(table.limit(0), quality._moments) == 0).all()


def test_text_features_are_finite():
    rng = random.Random(4)
    for text in (None, "", " ", "a", "!!", prose(rng, 5000), "\x00" * 10, "é" * 1000):
        values = quality.text_features(text)
        assert len(values) == quality.TEXT_FEATURES and np.isfinite(values).all()
