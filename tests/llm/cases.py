"""Documents with the odd cases that every operator has to take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use inside; documents that have them must not clash.
EXTRA = ("id", "key", "digest", "n", "label", "spans", "shard", "__id", "bucket", "found", "lm", "n_pieces", "__text", "__doc", "lost", "license_id", "accepted")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts(seed=5):
    rng = random.Random(seed)
    base, passage = prose(rng, 120), prose(rng, 60)
    out = [None, "", " \n\t ", "word", "Word", "two words", "a b c d e", "a b c d e f", "Ünïcode ▁ \U0001f600 text\x00\x1f", base, base.upper(), base.replace(" ", "  \n")]
    for k in range(8):  # near copies that differ more and more
        parts = base.split(" ")
        for j in range(k):
            parts[(j * 13 + k) % len(parts)] = f"new{j}{k}"
        out.append(" ".join(parts))
    out += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 25) for _ in range(12)]
    out += ["x" * 700, "x" * 431, "ab " * 300, prose(rng, 4000), passage, passage + " " + passage]
    return out


def rows(seed=5):
    found = [(k, t, "en" if k % 3 else None, f"src{k % 2}", None if t is None else len(t)) for k, t in enumerate(texts(seed))]
    return found + [found[9], found[20], (None, found[9][1], None, None, None), (None, "null id text here now", "en", "s", 1)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS)


def with_extra(df):
    return df.selectExpr("*", *[f"'extra' as `{c}`" for c in EXTRA])
