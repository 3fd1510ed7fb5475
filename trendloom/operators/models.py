"""Calling an injected model from a plan: one client per task, Arrow batches in and out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A factory is shipped to the executors and called once per task; what it returns is called
# with one text (responders) or a list of texts (embedders).
ResponderFactory = Callable[[], Callable[[str], str]]
EmbedderFactory = Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]

# Fixed value: how much of a failure's message is kept by default.
MESSAGE_LENGTH = 100
#: The failure of texts that were not sent, because the service was down.
NOT_ASKED = "not_asked"


def respond(
    factory: ResponderFactory, text: Column, pause_seconds: float = 0.0, message_length: int | None = MESSAGE_LENGTH,
    retries: int = 0, backoff_seconds: float = 1.0, breaker: int | None = None,
) -> Column:
    """``struct<raw, failure>`` of the model's answer to each text; null texts are not sent.

    A failing call is repeated up to ``retries`` times, after ``backoff_seconds`` and then twice as long each
    time. If it still fails it becomes its message, cut to ``message_length`` (None: whole), so one bad row
    does not fail the task. Once ``breaker`` texts in a row have failed in a task, the service is taken
    to be down: the task sends nothing more, and its other texts get the failure ``not_asked``. The
    column is non-deterministic, which keeps the optimizer from evaluating it twice.
    """

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client, failed = factory(), 0

        def one(item):
            nonlocal failed
            if item is None:
                return None, None
            if breaker is not None and failed >= breaker:
                return None, NOT_ASKED
            for attempt in range(retries + 1):
                try:
                    answer = client(item)
                    failed = 0
                    if pause_seconds:
                        time.sleep(pause_seconds)
                    return answer, None
                except Exception as error:  # the row carries the reason
                    message = str(error)[:message_length]
                    if attempt < retries and backoff_seconds:
                        time.sleep(backoff_seconds * 2**attempt)
            failed += 1
            return None, message

        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["raw", "failure"], dtype=object)

    return F.pandas_udf(ask, "raw string, failure string").asNondeterministic()(text)


def embed(factory: EmbedderFactory, text: Column, batch_size: int = 100) -> Column:
    """``array<float>`` vector of each text, sent to the model in lists of ``batch_size``.

    Non-deterministic for the optimizer, so a filter on the vector does not call the model again.
    """

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = factory()
        for texts in batches:
            items = texts.fillna("").tolist()
            vectors = []
            for start in range(0, len(items), batch_size):
                part = client(items[start : start + batch_size])
                vectors.extend([float(x) for x in vector] for vector in part)
            yield pd.Series(vectors, dtype=object)

    return F.pandas_udf(encode, "array<float>").asNondeterministic()(text)
