"""Answers kept by the digest of their text, so that a model sees each text once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.settle import settle
from trendloom.sources.tables import TableStore

DIGEST, TEXT = "_digest", "_asked"


def remembered(
    rows: DataFrame, text: Column, store: TableStore, layer: str, name: str, ask: Callable[[DataFrame], DataFrame],
    scope: str = "", keep: Column | None = None,
) -> DataFrame:
    """``rows`` with the columns that ``ask`` adds to a text, asking only for texts without a kept answer.

    ``ask`` gets a table of ``_digest, _asked``, one row per text that the table ``layer/name`` does not
    know, and returns ``_digest`` and the answer's columns. Those that fulfil ``keep`` (all, without it)
    are appended to the table; the others hold for this call only and are asked again by the next.
    ``scope`` names the model and its settings: answers of another scope do not count. A null text is
    not asked and has null answers. Equal texts meet as one row in each task before they are shuffled.
    """
    digest = F.sha2(F.concat(F.lit(f"{scope}\0"), text), 256)
    keyed = rows.withColumn(DIGEST, digest)
    wanted = keyed.withColumn(TEXT, text).filter(F.col(DIGEST).isNotNull()).groupBy(DIGEST).agg(F.first(TEXT).alias(TEXT))
    known = store.read_if_exists(layer, name)
    if known is not None:
        wanted = wanted.join(known.select(DIGEST), DIGEST, "left_anti")
    missing, n = settle(wanted)
    answers = known
    if n or known is None:
        found = settle(ask(missing))[0]  # one run of the model, whatever reads its answers
        good = found if keep is None else found.filter(keep)
        store.append(good, layer, name)
        answers = store.read(layer, name)
        if keep is not None:
            answers = answers.unionByName(found.filter(~keep | keep.isNull()))
    return keyed.join(answers, DIGEST, "left").drop(DIGEST)
