"""Cleaning expressions shared by the Silver plans. All are built-in, code-generated expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions._cols import ColumnLike, as_column


def clean_text(text: ColumnLike) -> Column:
    """Runs of ASCII whitespace become one space, ends are trimmed, blank becomes null.

    A no-break space is not ASCII whitespace and stays.
    """
    squeezed = F.regexp_replace(as_column(text), r"\s+", " ")
    return F.nullif(F.trim(squeezed), F.lit(""))


def not_blank(text: ColumnLike) -> Column:
    """True for text with something other than spaces in it, false for null."""
    return F.coalesce(F.length(F.trim(as_column(text))) > 0, F.lit(False))


def has_text(text: ColumnLike) -> Column:
    """True for text of which :func:`clean_text` leaves something, without cleaning it; null for null."""
    return as_column(text).rlike(r"\S")


def clean_url(url: ColumnLike) -> Column:
    """The url if it is an http(s) address and no placeholder of a removed article, else null."""
    url = as_column(url)
    usable = url.startswith("http") & ~url.contains("removed.com")
    return F.when(usable, url)


def parse_timestamp(value: ColumnLike) -> Column:
    """ISO text, epoch seconds or epoch seconds as text to a timestamp; anything else is null.

    ``try_cast`` keeps this safe under ANSI mode, where a plain cast of '' raises.
    """
    value = as_column(value)
    return F.coalesce(value.try_cast("timestamp"), value.try_cast("bigint").try_cast("timestamp"))


def unified_id(source: str, original_id: ColumnLike) -> Column:
    """md5 of ``source_id``: one key space over all feeds; a null id stays null."""
    return F.md5(F.concat(F.lit(f"{source}_"), as_column(original_id).cast("string")))


def article_id(url: ColumnLike) -> Column:
    """md5 of an article's address; a missing address hashes as the empty string."""
    return F.md5(F.coalesce(as_column(url), F.lit("")))
