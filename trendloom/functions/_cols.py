from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[Column, str]


def as_column(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def columns_of(struct: Column) -> Column:
    """The fields of a struct as columns, computed once per row.

    Fields picked from an expression in a projection are merged into whatever uses them, which
    parses a JSON text once for a filter and again for each field. A generator is a barrier.
    """
    return F.inline(F.array(struct))
