"""Rounding and fixed-point text with the conventions of numpy and of Python's formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions._cols import ColumnLike, as_column


# Wide enough for every fraction that can be near a half-way point, and small enough to be
# multiplied by 100 in 64 bits.
_BITS = 56


def round_scaled(value: ColumnLike, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding dashboards get from numpy."""
    scale = float(10**digits)
    return F.rint(as_column(value) * scale) / scale


def fixed_text(value: ColumnLike, digits: int) -> Column:
    """``f"{value:.{digits}f}"`` for 0 to 2 digits, exact to the last bit.

    Spark's own formatters round the shortest decimal text of a double, which moves values
    such as 12.65 (stored slightly above) to the wrong side. Here the fraction is taken as an
    integer of ``_BITS`` bits plus what is left below them, so the half-way case is decided on
    the stored value, ties to even.
    """
    if not 0 <= digits <= 2:
        raise ValueError("digits must be 0, 1 or 2")
    value = as_column(value).cast("double")
    scale = 10**digits
    size = F.abs(value)
    whole = F.floor(size).cast("bigint")
    fraction = (size - whole) * float(1 << _BITS)
    below = (fraction - F.floor(fraction)) * float(scale)
    scaled = F.floor(fraction).cast("bigint") * scale + F.floor(below).cast("bigint")
    low = scaled.bitwiseAND((1 << _BITS) - 1)
    kept = F.shiftright(scaled, _BITS) + whole * scale
    half = F.lit(1 << (_BITS - 1))
    tie = (low == half) & (below == F.floor(below))
    up = F.when(tie, kept % 2 == 1).otherwise(low >= half)
    units = kept + up.cast("int")
    if digits == 0:
        text = units.cast("string")
    else:
        decimals = F.lpad((units % scale).cast("string"), digits, "0")
        text = F.concat(F.floor(units / scale).cast("string"), F.lit("."), decimals)
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), text)


def rounded_text(value: ColumnLike, digits: int) -> Column:
    """``str(round(value, digits))``: fixed text without trailing zeros, one decimal at least."""
    text = fixed_text(value, digits)
    if digits == 0:
        return F.concat(text, F.lit(".0"))
    if digits == 1:
        return text
    return F.regexp_replace(text, r"(\.\d)0$", "$1")
