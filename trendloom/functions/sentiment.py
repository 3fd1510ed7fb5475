"""Sentiment labels, their weights, and measures over label counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions._cols import ColumnLike, as_column

POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"


@dataclass(frozen=True)
class Weights:
    """What one item of each label counts; neutral and unlabelled items share a value."""

    positive: float
    negative: float
    otherwise: float

    def of(self, sentiment: ColumnLike) -> Column:
        sentiment = as_column(sentiment)
        return (
            F.when(sentiment == POSITIVE, F.lit(self.positive))
            .when(sentiment == NEGATIVE, F.lit(self.negative))
            .otherwise(F.lit(self.otherwise))
        )

    def average(self, positive: ColumnLike, negative: ColumnLike, rest: ColumnLike) -> Column:
        """Mean weight of a group from its label counts.

        Counting first and weighting once makes the mean independent of the order in which
        partial sums arrive, so equal groups get equal scores and ties in ranks are stable.
        """
        positive, negative, rest = map(as_column, (positive, negative, rest))
        weighted = positive * self.positive + negative * self.negative + rest * self.otherwise
        return weighted / (positive + negative + rest)


# Weights of the Gold scores.
TREND_WEIGHTS = Weights(positive=1.2, negative=0.8, otherwise=1.0)
MOMENTUM_WEIGHTS = Weights(positive=1.3, negative=0.7, otherwise=1.0)
CONTENT_BOOST = Weights(positive=1.1, negative=0.95, otherwise=1.0)
ACTIVITY_WEIGHTS = Weights(positive=1.0, negative=-1.0, otherwise=0.0)


def count_label(label: str, sentiment: ColumnLike = "sentiment") -> Column:
    """Aggregate: rows carrying this label."""
    return F.count_if(as_column(sentiment) == label)
