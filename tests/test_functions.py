import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.functions.numbers import fixed_text, round_scaled, rounded_text
from trendloom.functions.text import (
    article_id,
    clean_text,
    clean_url,
    not_blank,
    parse_timestamp,
    unified_id,
)


def apply(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    result = rows.select("i", expression.alias("r")).collect()
    return [row.r for row in sorted(result, key=lambda row: row.i)]


def test_clean_text(spark):
    given = [" two  words ", "two   words", "a\t\n b\x0b\f\rc", "   ", "", None, " x "]
    assert apply(spark, given, "string", clean_text("v")) == [
        "two words", "two words", "a b c", None, None, None, " x ",
    ]


def test_not_blank(spark):
    assert apply(spark, ["x", " ", "", None], "string", not_blank("v")) == [True, False, False, False]


def test_clean_url(spark):
    given = ["https://site.test/p?q=1", "https://removed.com/x", "ftp://x", "", None, "http://a"]
    assert apply(spark, given, "string", clean_url("v")) == [
        "https://site.test/p?q=1", None, None, None, None, "http://a",
    ]


def test_parse_timestamp_of_text(spark):
    given = [
        "2024-01-15T10:23:00Z", "2024-01-15 10:23:00", "2024-01-15T12:23:00+02:00", "1705314180",
        "", "n/a", None, "99999999999999999999",
    ]
    at = F.date_format(parse_timestamp("v"), "yyyy-MM-dd HH:mm:ss")
    same = "2024-01-15 10:23:00"
    assert apply(spark, given, "string", at) == [same, same, same, same, None, None, None, None]


def test_parse_timestamp_of_epoch(spark):
    at = F.date_format(parse_timestamp("v"), "yyyy-MM-dd HH:mm:ss")
    assert apply(spark, [0, 1705314180, None], "bigint", at) == [
        "1970-01-01 00:00:00", "2024-01-15 10:23:00", None,
    ]


def test_unified_id(spark):
    first, again, none = apply(spark, ["8675309", "8675309", None], "string", unified_id("hackernews", "v"))
    other = apply(spark, ["8675309"], "string", unified_id("github", "v"))[0]
    assert first == again and len(first) == 32 and set(first) <= set("0123456789abcdef")
    assert first != other
    assert none is None
    assert apply(spark, [8675309], "bigint", unified_id("hackernews", "v")) == [first]


def test_article_id(spark):
    missing, empty, url, other = apply(spark, [None, "", "https://a/1", "https://a/2"], "string", article_id("v"))
    assert missing == empty == "d41d8cd98f00b204e9800998ecf8427e"
    assert len({missing, url, other}) == 3


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_fixed_text_is_python_formatting(spark, digits):
    rng = random.Random(digits)
    values = [0.0, 0.5, 1.5, 2.5, 12.25, 12.35, 12.65, 0.15, 0.05, 99.995, 1e9 + 0.25, -3.25, -0.35]
    values += [rng.uniform(0, 10**e) for e in range(-2, 12) for _ in range(30)]
    values += [rng.randrange(0, 10**6) / 1000 for _ in range(300)]
    assert apply(spark, values, "double", fixed_text("v", digits)) == [f"{v:.{digits}f}" for v in values]


@pytest.mark.parametrize("digits", [1, 2])
def test_rounded_text_is_python_round(spark, digits):
    rng = random.Random(digits)
    values = [0.0, 13.2, 13.0, 13.25, 100.0, 87.35] + [rng.uniform(0, 1e5) for _ in range(300)]
    assert apply(spark, values, "double", rounded_text("v", digits)) == [str(round(v, digits)) for v in values]


def test_round_scaled_ties_to_even(spark):
    got = apply(spark, [0.125, 0.375, 2.5, None, math.pi], "double", round_scaled("v", 2))
    assert got == [0.12, 0.38, 2.5, None, 3.14]


def test_hour_windows_are_utc(spark):
    hour = apply(spark, ["2024-01-15T23:59:59-01:00"], "string",
                 F.date_trunc("hour", parse_timestamp("v")).cast("timestamp_ntz"))
    assert hour == [datetime(2024, 1, 16, 0)]
