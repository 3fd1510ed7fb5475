"""Source mixing, importance resampling and vector codes against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import DOCS, frame, prose, rows, with_extra
from trendloom.llm import ball_codes, importance, mixing

# ---- source mixing --------------------------------------------------------------------------


def hash_of(i, text):
    name = str(i) if i is not None else "" if text is None else hashlib.sha256(text.encode()).hexdigest()
    return int(hashlib.sha256(f"mix:{name}".encode()).hexdigest()[:15], 16)


def targets_by_rounds(sizes, weights, budget, most=3):
    """Deal the budget by weight, stop what is above, deal the excess again."""
    got, full = {s: 0.0 for s in sizes}, set()
    while True:
        rest = sum(w for s, w in weights.items() if s not in full)
        left = budget - sum(most * sizes[s] for s in full)
        for s in sizes:
            got[s] = most * sizes[s] if s in full else weights[s] * left / rest
        above = {s for s in sizes if s not in full and got[s] > most * sizes[s]}
        if not above:
            return got
        full |= above
        if len(full) == len(sizes):
            return {s: most * sizes[s] for s in sizes}


def mix_brute(data, cycle=(5, 2, 1), budget=1.0):
    docs = [(i, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), hash_of(i, text)) for i, text, source in data]
    sizes = collections.Counter()
    for _, source, n, _ in docs:
        sizes[source] += n
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    targets, out = targets_by_rounds(sizes, weights, int(budget * sum(sizes.values()))), []
    for source in names:
        own = [d for d in docs if d[1] == source]
        whole = math.floor(targets[source] / sizes[source]) if sizes[source] else 0
        need, by_hash = targets[source] - whole * sizes[source], collections.Counter()
        for _, _, n, h in own:
            by_hash[h] += n
        above, more = 0, set()
        for h in sorted(by_hash):
            if need > 0 and above + by_hash[h] < need or above < need <= above + by_hash[h] and (need - above) * 2 >= by_hash[h]:
                more.add(h)
            elif above >= need or need <= above + by_hash[h]:
                break
            above += by_hash[h]
        for i, _, n, h in own:
            out.append((i, n, sizes[source], round(targets[source], 6), n * (whole + (h in more))))
    return collections.Counter(out)


def told(df):
    return collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def many(n=300, seed=3):
    """A hot source, a small one, one without words, and one without a name."""
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["tiny", None, "b", "ü", "𝒵", "￿"]
    data = [(k, prose(rng, rng.choice([1, 5, 40, 200])), rng.choice(names)) for k in range(n)]
    return data + [(n + k, None, "mute") for k in range(3)]


def of_triples(spark, data):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in data], DOCS)


def test_mix_against_brute_force(spark):
    data = many()
    assert told(mixing.mix(with_extra(of_triples(spark, data)))) == mix_brute(data)
    odd = [(i, t, s) for i, t, _, s, _ in rows()]
    assert told(mixing.mix(frame(spark))) == mix_brute(odd)
    data = [(k, prose(random.Random(k), 3), "only") for k in range(7)]  # one source takes all of itself
    got = mixing.mix(of_triples(spark, data)).collect()
    assert all(r.taken == r.size == 3 and r.target == r.source_size == 21 for r in got)


def test_mix_comes_near_its_targets_and_stops_at_three_times(spark):
    data = [(k, prose(random.Random(k), 10), "aa" if k < 4 else "b" if k < 60 else "c") for k in range(400)]
    got = mixing.mix(of_triples(spark, data)).collect()
    taken, target, most = collections.Counter(), {}, collections.Counter()
    for r, (_, _, s) in zip(sorted(got, key=lambda r: r.doc_id), data):
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken <= 3 * r.size
    assert target["aa"] == 120 and taken["aa"] == 120  # stopped; the excess went to the others
    assert abs(sum(target.values()) - 4000) < 1e-6 and all(abs(taken[s] - target[s]) <= 5 for s in target) and not most


def test_targets_of_more_words_than_an_int_can_weigh(spark):
    """Five times a budget that fits into 32 bits does not."""
    for unit in (3 * 10**8, 3 * 10**9):
        sizes, weights = {"a": unit, "b": 4 * unit, "c": unit // 100}, {"a": 5, "b": 2, "c": 1}
        sources = spark.createDataFrame([(s, sizes[s], weights[s]) for s in sizes], "source string, source_size long, weight int")
        got = {r.source: r.target for r in mixing.find_targets(sources).collect()}
        assert got == pytest.approx(targets_by_rounds(sizes, weights, sum(sizes.values())))
        assert got["a"] == 3 * unit and got["c"] == 3 * unit // 100  # both stop, and the rest is dealt again


def test_mixes_of_growing_budgets_are_nested(spark):
    docs = of_triples(spark, many())
    budgets = (0.1, 0.25, 0.7, 1.0)
    copies = collections.defaultdict(list)
    for r in mixing.mix(docs, budgets=budgets).orderBy("budget").collect():
        copies[r.doc_id].append(r.copies)
    assert all(len(c) == 4 and c == sorted(c) for c in copies.values()) and any(c[0] < c[3] for c in copies.values())
    for b in budgets:
        assert told(mixing.mix(docs, budgets=(b,))) == mix_brute(many(), budget=b)


def test_equal_hashes_and_refinement(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", 4)  # many levels for few documents
    data = many(200, 8) + [(None, "same text here", "hot")] * 40 + [(5, "other words", "b")] * 3
    assert told(mixing.mix(of_triples(spark, data))) == mix_brute(data)


def test_repeat_documents_and_given_weights(spark):
    docs = with_extra(of_triples(spark, many()).withColumn("_doc", F.lit(1)).withColumn("_hash", F.lit("x")).withColumn("threshold", F.lit("t")))
    sizes = mixing.measure(docs)
    weights = spark.createDataFrame([("hot", 1), (None, 3), ("tiny", 0)], "source string, weight int")
    limits = mixing.find_thresholds(sizes, weights)
    assert {r.source for r in limits.filter("target > 0").collect()} == {"hot", None}
    out = mixing.repeat_documents(docs, limits)
    assert out.schema == docs.schema
    got = collections.Counter(r.doc_id for r in out.collect())
    want = {r.doc_id: r.copies for r in mixing.mix(docs, weights).collect() if r.copies}
    assert got == collections.Counter(want) and max(want.values()) == 3
    nothing = spark.createDataFrame([], "source string, weight int")
    assert mixing.mix(docs, nothing).agg(F.sum("taken")).first()[0] == 0


def test_mix_of_empty_tables(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert [(r.size, r.target, r.taken) for r in mixing.mix(frame(spark, [(1, None, None, None, None), (2, " ", None, "s", 1)])).collect()] == [(0, 0.0, 0)] * 2


def test_mix_stays_with_built_in_functions(spark):
    plan = mixing.mix(of_triples(spark, many()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)


# ---- importance resampling ------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features_of(text, n=1):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def resample_brute(docs, target, n=1, percent=10, least=20):
    sums = lambda texts: collections.Counter(b for t in texts for b in features_of(t, n)[1])
    s, t = sums(x for _, x in docs), sums(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    scored = []
    for i, text in docs:
        n_words, found = features_of(text, n)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        scored.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((x for x in scored if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    drawn = able[: percent * len(able) // 100]
    return collections.Counter((*x[:4], k + 1) for k, x in enumerate(drawn)) + collections.Counter(
        (*x[:4], None) for x in able[len(drawn) :] + [x for x in scored if x[4] < least])


@pytest.mark.parametrize("n, percent", [(1, 10), (2, 35), (3, 100)])
def test_resampling_against_brute_force(spark, n, percent):
    rng = random.Random(4)
    data = [(i, t) for i, t, *_ in rows()] + [(1000 + k, prose(rng, rng.choice([3, 19, 20, 60]))) for k in range(150)]
    target = [None, "", prose(rng, 300), "Word two words ab cd"]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], DOCS)
    items = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    got = importance.resample(with_extra(docs), items, n=n, percent=percent).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == resample_brute(data, target, n, percent)


def test_repeated_rows_ties_and_long_texts(spark):
    rng = random.Random(6)
    long = prose(rng, 400_000) + " " + "x" * 3_000_000  # over a few MB, with one word of 3 MB
    data = [(7, prose(random.Random(1), 30))] * 40 + [(None, prose(rng, 25))] * 3 + [(9, long)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in data], DOCS)
    items = spark.createDataFrame([("x y z",)], "text string")
    got = importance.resample(docs, items, percent=50).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == resample_brute(data, ["x y z"], percent=50)


def test_resampling_of_empty_tables_and_kept_rows(spark):
    docs, none = frame(spark), spark.createDataFrame([], "text string")
    assert importance.resample(frame(spark, []), none).collect() == []
    assert all(r.weight is not None for r in importance.resample(docs, none).collect())
    kept = importance.keep_drawn(with_extra(docs), docs, percent=50)
    drawn = {r.doc_id for r in importance.resample(docs, docs, percent=50).filter("rank is not null").collect()}
    assert drawn and {r.doc_id for r in kept.collect()} == drawn and kept.columns == with_extra(docs).columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=300), max_size=40))
def test_checksums_by_columns(slices):
    data = np.frombuffer(b"".join(slices) + b"\0", np.uint8)
    sizes = np.array([len(s) for s in slices], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
    assert importance.crc_of(data, starts, sizes, importance.crc_table()).tolist() == [zlib.crc32(s) for s in slices]


@pytest.mark.parametrize("gather", [5, 1 << 20])
def test_feature_buckets_of_batches(monkeypatch, gather):
    monkeypatch.setattr(importance, "GATHER_BYTES", gather)
    rng, table = random.Random(2), importance.crc_table()
    for _ in range(80):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(["a", "B", " ", "é", "-", "1", "日", "\n"]) for _ in range(rng.choice([0, 1, 30]))) for _ in range(rng.choice([0, 1, 6]))]
        n = rng.choice([1, 2, 3])
        found, before, words = importance.feature_buckets(pa.array(texts, pa.string()), n, 10000, table)
        want = [features_of(t, n) for t in texts]
        assert words.tolist() == [w for w, _ in want]
        assert [sorted(found[a:b].tolist()) for a, b in zip(before, before[1:])] == [sorted(f) for _, f in want]


# ---- vector codes ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def codes_brute(data, parts=16, entries=64, rounds=2):
    """Every part against every entry, in whole numbers of any size."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: [min((gap(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        found = [nearest(v) for _, v, _ in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(xs) // len(own) for xs in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = [nearest(v) for _, v, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = collections.Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    return collections.Counter(
        (i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest) for (i, _, label), f, e in zip(kept, found, errors)), books


def coded(df, **options):
    return collections.Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in ball_codes.compress(df, **options).collect())


def some_vectors(n=250, size=64, seed=1):
    rng = random.Random(seed)
    data = [(k, [rng.gauss(0, 0.2) for _ in range(size)], rng.choice([0, 1, 1, None])) for k in range(n)]
    hot = data[3][1]
    data += [(n + k, hot, 1) for k in range(n // 2)]  # a third of the rows is one vector
    nan, inf = float("nan"), float("inf")
    data += [(None, data[5][1], 2), (4, data[6][1], None), (4, data[6][1], None), (-1, None, 0), (-2, [nan] * size, 0), (-3, [inf] + [0.0] * (size - 1), 0), (-4, [None] * size, 1)]
    rng.shuffle(data)
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in data]


def test_codes_against_brute_force(spark):
    data = some_vectors()
    df = spark.createDataFrame(data, VECTORS).repartition(7)
    assert coded(df.selectExpr("*", "1 as id", "'x' as codes", "2 as whole", "3 as error", "4 as _label", "5 as given")) == codes_brute(data)[0]


@pytest.mark.parametrize("options", [{"rounds": 0}, {"rounds": 1, "entries": 3}, {"parts": 1, "entries": 256}, {"parts": 64, "rounds": 4, "entries": 9}])
def test_codes_with_other_settings(spark, options):
    data = some_vectors(60)
    assert coded(spark.createDataFrame(data, VECTORS), **options) == codes_brute(data, **options)[0]


def test_few_empty_and_unfit_vectors(spark):
    few = [(1, [0.5, -0.5], 1), (2, [0.5, 0.25], None)]
    assert coded(spark.createDataFrame(few, VECTORS), parts=2) == codes_brute(few, parts=2)[0]
    assert coded(spark.createDataFrame([], VECTORS)) == coded(spark.createDataFrame([(1, None, 1)], VECTORS)) == collections.Counter()
    no_id = [(None, [float(k), 1.0], 1) for k in range(5)]
    assert coded(spark.createDataFrame(no_id, VECTORS), parts=2, entries=3) == codes_brute(no_id, parts=2, entries=3)[0]
    with pytest.raises(ValueError, match="divide"):
        coded(spark.createDataFrame([(1, [1.0] * 5, 1)], VECTORS))
    with pytest.raises(Exception, match="one length"):
        coded(spark.createDataFrame([(k, [1.0] * (16 if k < 70 else 32), 1) for k in range(80)], VECTORS))
    with pytest.raises(Exception, match="65536"):
        coded(spark.createDataFrame([(1, [1e9] * 16, 1)], VECTORS))


def test_decoded_vectors_are_near(spark):
    data = [r for r in some_vectors() if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows_, books = ball_codes.learn_codes(ball_codes.whole_vectors(spark.createDataFrame(data, VECTORS)))
    for r in ball_codes.decode(rows_, books).collect():
        assert sum((w - 256 * a) ** 2 for w, a in zip(r.whole, r.approximate)) == r.error


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(0, 200), st.integers(1, 5), st.sampled_from([2, 9, 300, 10**7]))
def test_balls_find_what_all_comparisons_find(seed, k, n, size, spread):
    rng = np.random.default_rng(seed)
    x, entries = (rng.integers(-spread, spread + 1, (m, size)).astype(float) for m in (n, k))
    want = ball_codes.assign_all(x, entries)
    for old in (rng.integers(0, k, n), want[0]):
        got = ball_codes.assign_near(x, entries, old)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_balls_save_comparisons():
    rng = np.random.default_rng(1)
    middles = rng.integers(-5000, 5000, (64, 4)).astype(float)
    x = middles[rng.integers(0, 64, 20000)] + rng.integers(-40, 41, (20000, 4))
    codes, _ = ball_codes.assign_all(x, middles)
    assert ball_codes.assign_near(x, middles, codes)[2] < 20000  # of 1,280,000
