"""Quality classifier by co-training: one view reads the text, the other the page's metadata.

Both views learn from a bounded sample of labelled documents. Over some rounds each names all
unlabelled documents that it is sure of, wherever they lie, and the other view learns from them: a
pass sums up their gradients and Hessians in each task, and only the sums reach the driver. Each
view's output is calibrated on labelled rows kept aside, and both together give the score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import free_name, small_batches, stored

#: Labelled documents that are learned from, at most.
LABELLED = 12_000
#: Rounds, and passes over the unlabelled documents in a round, at most; weights that move less stand.
ROUNDS, PASSES, SURE, MOVED = 5, 4, 0.97, 1e-2
#: Rows of sums that reach the driver, at most.
GATHERED = 16
#: One labelled row in so many is kept for calibration.
ASIDE = 4
#: Documents below this probability of being good are rejected.
THRESHOLD = 0.5
#: Buckets for hashed metadata values.
BUCKETS = 16

TEXT_FEATURES = 22
META_FEATURES = 3 * BUCKETS + 6


def text_features(text: str | None) -> list[float]:
    """Shares and lengths that tell prose from repetition, shouting, symbols and tables."""
    if not text or not (words := text.split()):
        return [0.0] * TEXT_FEATURES
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    size, n = len(raw), len(words)
    seen = Counter(words)
    doubles = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    stops = sum(text.count(c) for c in ".?")
    share = lambda a, b: counts[a : b + 1].sum() / size
    symbols = sum(int(counts[ord(c)]) for c in "#$%&*+<=>@^_|~\\/{}[]") / size
    packed = len(zlib.compress(raw.tobytes(), 1)) / size
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum()) / n
    return [
        1.0 if n < 5 else 0.0, math.log1p(n), math.log1p(size / n), len(seen) / n, len(seen) / math.sqrt(n),
        seen.most_common(1)[0][1] / n, doubles / n, pairs / n, 1 - len(set(lines)) / max(1, len(lines)),
        share(65, 90), share(97, 122), share(48, 57), share(128, 255), counts[33] / size * 10, symbols * 10,
        counts[124] / size * 10, min(1.0, stops / n), math.log1p(n / max(1, len(lines))), packed, lone,
        sum(1 for w in words if w.isupper() and len(w) > 1) / n, sum(1 for w in words if not w[-1].isalnum()) / n,
    ]


def meta_features(lang: str | None, source: str | None, n_chars: int | None, url: str | None) -> list[float]:
    """Hashed language, source and host, the stated length, and the form of the page's url."""
    out = [0.0] * META_FEATURES
    host = url.split("://", 1)[-1].split("/", 1)[0].lower() if url else None
    for k, value in enumerate((lang, source, host)):
        if value is not None:
            out[k * BUCKETS + zlib.crc32(value.encode("utf-8", "surrogatepass")) % BUCKETS] = 1.0
    path = url.split("://", 1)[-1].partition("/")[2] if url else ""
    out[3 * BUCKETS :] = [
        math.log1p(max(0, n_chars or 0)), math.log1p(max(0, n_chars or 0)) ** 2 / 10, float(url is None),
        float("?" in path), path.count("/") / 4, float(bool(lang) and f"/{lang}/" in f"/{path}/"),
    ]
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(t) for t in batch.column("__text").to_pylist()]
        columns = [batch.column(c) for c in ("id", "lang", "source", "n_chars")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(pa.float32()))], names=["id", "lang", "source", "n_chars", "text_view"])


def _with_meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [meta_features(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars", "url")))]
        columns = [batch.column(c) for c in ("id", "label", "text_view")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(pa.float32()))], names=["id", "label", "text_view", "meta_view"])


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    flat = lambda c, n: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)
    return flat("text_view", TEXT_FEATURES), flat("meta_view", META_FEATURES)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression with an intercept in front, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    weights, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - keep * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class View:
    """A classifier over standardised features, with the line that calibrates its log-odds."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    line: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -8, 8)

    def odds(self, x: np.ndarray) -> np.ndarray:
        raw = self.standard(x) @ self.weights[1:] + self.weights[0]
        return self.line[0] + self.line[1] * np.clip(raw, -30, 30)

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> View:
        plain = replace(self, line=np.array([0.0, 1.0]))
        return replace(self, line=fit_logistic(plain.odds(x)[:, None], y, ridge=1e-3))

    def pull(self, x: np.ndarray, good: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the likelihood of rows at the weights."""
        x = np.column_stack([np.ones(len(x)), self.standard(x)])
        p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        return x.T @ (good - p), (x * (p * (1 - p))[:, None]).T @ x


@dataclass
class Judge:
    """Both calibrated views and the weights that combine their log-odds."""

    text: View
    meta: View
    mix: np.ndarray

    def score(self, text_view: np.ndarray, meta_view: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one, two = self.text.odds(text_view), self.meta.odds(meta_view)
        both = self.mix[0] + self.mix[1] * one + self.mix[2] * two
        return tuple(1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in (both, one, two))


def _moments(text: np.ndarray, meta: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(text)], *[f(x).sum(axis=0) for x in (text, meta) for f in (np.asarray, np.square)]])


def _taught(teachers: list[View], students: list[View], sure: float, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
    """For each view, and for good and bad: how many rows the other is sure of, their gradient and Hessian."""
    out, views, least = [], (text, meta), math.log(sure / (1 - sure))
    for k in (0, 1):
        odds = teachers[1 - k].odds(views[1 - k])
        for good, rows in ((1.0, odds >= least), (0.0, odds <= -least)):
            slope, bend = students[k].pull(views[k][rows], good)
            out += [[rows.sum()], slope, bend.ravel()]
    return np.concatenate(out)


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, aside: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, **options) -> Judge:
    """:func:`co_train_over` unlabelled rows in memory."""
    return co_train_over(text, meta, y, aside, lambda f: f(pool_text, pool_meta), **options)


def co_train_over(text: np.ndarray, meta: np.ndarray, y: np.ndarray, aside: np.ndarray, total: Callable, rounds: int = ROUNDS, passes: int = PASSES, sure: float = SURE) -> Judge:
    """Fits both views. ``aside`` marks the labelled rows that only calibrate; ``total`` gives the sum
    of a function of both views over all unlabelled rows.

    In each round a view names every unlabelled row of which it is at least ``sure``, and the other
    view learns them by Newton steps. Named rows of a kind weigh as much as its labelled rows together
    at most, so labels are never outvoted; the ridge shrinks with that weight, so rare rows still count.
    """
    fit, views = ~aside, [text, meta]
    sums = total(_moments) + _moments(text[fit], meta[fit])
    a, b = text.shape[1], meta.shape[1]
    parts = np.split(sums[1:] / sums[0], np.cumsum([a, a, b]))
    learned = []
    for x, middle, square in zip(views, parts[::2], parts[1::2]):
        view = View(middle, np.sqrt(np.maximum(square - middle**2, 0)) + 1e-6, np.zeros(x.shape[1] + 1), np.array([0.0, 1.0]))
        view = replace(view, weights=fit_logistic(view.standard(x[fit]), y[fit]))
        learned.append(view.calibrated(x[aside], y[aside]))
    known = np.array([y[fit].sum(), (1 - y[fit]).sum()])
    for _ in range(rounds):
        teachers, before = list(learned), [v.weights for v in learned]
        for _ in range(passes):
            sums = total(partial(_taught, teachers, learned, sure))
            at, moved = 0, 0.0
            for k, view in enumerate(learned):
                size = len(view.weights)
                named = sums[at : at + 2 * (1 + size + size**2)].reshape(2, -1)
                at += named.size
                weigh = np.minimum(1, known / np.maximum(1, named[:, 0]))
                keep = np.full(size, max(1e-2, weigh.min()))
                keep[0] = 1e-6
                slope, bend = view.pull(views[k][fit], y[fit])
                slope = slope + weigh @ named[:, 1 : 1 + size] - keep * view.weights
                bend = bend + (weigh @ named[:, 1 + size :]).reshape(size, size) + np.diag(keep)
                step = np.linalg.solve(bend, slope)
                step *= min(1, 4 / max(1e-9, np.abs(step).max()))
                learned[k] = replace(view, weights=view.weights + step)
                moved = max(moved, np.abs(step).max())
            if moved < MOVED:
                break
        learned = [v.calibrated(x[aside], y[aside]) for v, x in zip(learned, views)]
        if max(np.abs(v.weights - w).max() for v, w in zip(learned, before)) < MOVED:
            break
    one, two = learned
    odds = np.column_stack([one.odds(text[aside]), two.odds(meta[aside])])
    return Judge(one, two, fit_logistic(odds, y[aside], ridge=1.0))


def _summed(rows: DataFrame, f: Callable) -> np.ndarray:
    """Sum of ``f(text, meta)`` over all rows: in each task, then in few groups of tasks, then here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sum((f(*_views(batch)) for batch in batches if batch.num_rows), 0.0)
        if np.ndim(own):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GATHERED], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(s) for s in table.column("sums").to_pylist())
        return pa.table({"sums": pa.array([sums.tobytes()], pa.binary())})

    found = rows.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(add, "sums binary").collect()
    nothing = np.zeros_like(f(np.zeros((0, TEXT_FEATURES)), np.zeros((0, META_FEATURES))))
    return sum((np.frombuffer(r["sums"]) for r in found), nothing)


def _scored(judge: Judge | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            scores = [np.ones(n)] * 3
            if judge is not None and n:
                scores = judge.score(*_views(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(s) for s in scores]], names=["id", "score", "text_score", "meta_score"])

    return run


#: Hashes of ids lie below this.
_HASHES = 1 << 62


def _hash() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(_HASHES))


def _candidates(rows: DataFrame, most: int) -> DataFrame:
    """A few more than ``most`` labelled documents, one row each: a threshold on the hash of the id is set
    by their number, so no task sends rows that others have enough of.
    """
    n = rows.agg(F.count_distinct("id")).first()[0]
    near = rows.withColumn("hash", _hash())
    if n > most:
        near = near.filter(F.col("hash") < int(_HASHES * min(1.0, (most + 8 * math.sqrt(most) + 16) / n)))
    least = F.min(F.struct("label", "text_view", "meta_view")).alias("row")
    return near.groupBy("hash", "id").agg(least).select("hash", "id", "row.*")


def _sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, list]:
    """At most ``most`` rows, those of the least hash of the id: their two views and labels."""
    picked = _candidates(rows, most).orderBy("hash", "id").limit(most).collect()
    text = np.array([r["text_view"] for r in picked], float).reshape(-1, TEXT_FEATURES)
    meta = np.array([r["meta_view"] for r in picked], float).reshape(-1, META_FEATURES)
    return text, meta, picked


def score_quality(
    docs: DataFrame, labels: DataFrame, pages: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    labelled: int = LABELLED, threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col, score, text_score, meta_score, accepted`` for each row of ``docs``.

    ``docs`` has lang, source and n_chars besides id and text; ``pages`` has page_id (the id of the
    document) and url. Any of these may be null and gives a feature of its own or zero; empty texts
    have zero text features. Of several labels or urls of an id the least counts, null labels count
    not. At most ``labelled`` documents, those of the least hash of their id, are learned from by their
    labels; all others, labelled or not, take part as unlabelled ones. Without two kinds of labels nothing can be learned: all scores are 1 and all are accepted.
    Rows that repeat an id are scored each for itself.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col("lang").cast("string"), F.col("source").cast("string"),
        F.col("n_chars").cast("long"), F.col(text_col).cast("string").alias("__text"),
    )
    schema = "id long, lang string, source string, n_chars long, text_view array<float>"
    urls = pages.filter("page_id is not null").groupBy(F.col("page_id").cast("long").alias("id")).agg(F.min("url").alias("url"))
    told = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    featured = narrow.mapInArrow(_featured, schema).join(urls, "id", "left").join(told, "id", "left")
    rows = stored(featured.mapInArrow(_with_meta, "id long, label int, text_view array<float>, meta_view array<float>"))
    text, meta, picked = _sample(rows.filter("label is not null"), labelled)
    y = np.array([r["label"] for r in picked], float)
    aside = np.array([zlib.crc32(f"aside {r['id']}".encode()) % ASIDE == 0 for r in picked], bool)
    judge = None
    if len(y) and all(0 < y[part].sum() < part.sum() for part in (aside, ~aside)):
        # Labelled rows that the bound leaves out are learned from like unlabelled ones.
        rest = F.col("label").isNull() | (_hash() > picked[-1]["hash"])
        judge = co_train_over(text, meta, y, aside, partial(_summed, rows.filter(rest)))
    scored = rows.mapInArrow(_scored(judge), "id long, score double, text_score double, meta_score double")
    return scored.withColumn("accepted", F.col("score") >= threshold).withColumnRenamed("id", id_col)


def drop_rejected(docs: DataFrame, labels: DataFrame, pages: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The accepted rows of ``docs`` with their columns; only ids of rejected ones travel.

    Rows that repeat an id go if one of them is rejected; rows with a null id go if the null id's are.
    """
    lost = score_quality(docs, labels, pages, id_col=id_col, **options).filter("not accepted")
    lost = lost.select(F.col(id_col).alias(free_name(docs, "lost"))).distinct()
    return docs.join(lost, docs[id_col].eqNullSafe(lost[lost.columns[0]]), "left_anti")
