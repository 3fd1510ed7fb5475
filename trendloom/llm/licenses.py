"""License scan: canonical digests of entire texts, joined to the digests of known licenses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.license_texts import KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Punctuation beyond ASCII, read as space.
MARKS = "“”„‘’‚«»–—―…•·"
#: A line that opens with a copyright mark or claims all rights, behind any decoration.
COPYRIGHT_LINE = r"(^|\n)[ \t\r*#/;-]*(copyright|copr\.|\(c\)|©|all rights reserved)[^\n]*"
#: Spellings that mean the same, as they stand once punctuation is gone; applied in this order.
EQUIVALENT = (
    ("licence", "license"), ("licencing", "licensing"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"),
    ("https", "http"), ("organis", "organiz"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"), ("analogue", "analog"), ("per cent", "percent"), ("copy right", "copyright"),
    ("merchantibility", "merchantability"), ("version v", "version "),
)


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, words parted by one space, one spelling; null as empty."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    out = F.regexp_replace(F.translate(out, MARKS, " " * len(MARKS)), r"[^a-z0-9\x{80}-\x{10FFFF}]+", " ")
    for old, new in EQUIVALENT:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def texts_in(spark: SparkSession, folder: str) -> DataFrame:
    """``license_id, text`` of a folder of license texts, each file a text and its name the id."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.txt|\.md)?$", 1)
    return spark.read.text(folder, wholetext=True).select(F.url_decode(name).alias("license_id"), F.col("value").alias("text"))


def known_licenses(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``license_id, license_sha256`` of the known texts; ids that share a canonical text are joined by ``|``.

    ``known`` is a list of (id, text) or a table ``license_id, text``. Texts that are null or hold
    nothing but copyright lines are not known licenses.
    """
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(list(known), "license_id string, text string")
    named = texts.select("license_id", canonical(F.col("text")).alias("text")).filter("text != ''")
    digest = F.sha2("text", 256).alias("license_sha256")
    return named.groupBy(digest).agg(F.array_join(F.array_sort(F.collect_set("license_id")), "|").alias("license_id"))


def license_scan(texts: DataFrame, *, text_col: str = "text", known=KNOWN) -> DataFrame:
    """Adds ``canonical_sha256`` and ``license_id`` (null where the entire text is no known license).

    Null and empty texts, and texts of nothing but copyright lines, have the digest of the empty
    text and no license. Known digests are one row per text given in ``known``. A list is held by
    the program, so its broadcast does not grow with the data; how a table is joined is left to
    Spark, which measures it. Columns of the same names are replaced.
    """
    digest = F.sha2(canonical(F.col(text_col)), 256)
    digests = texts.withColumn("canonical_sha256", digest).drop("license_id")
    table = known_licenses(texts.sparkSession, known)
    if not isinstance(known, DataFrame):
        table = F.broadcast(table)
    same = digests["canonical_sha256"] == table["license_sha256"]
    return digests.join(table, same, "left").drop(table["license_sha256"])


def document_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", known=KNOWN) -> DataFrame:
    """``id_col, canonical_sha256, license_id, statements``: the license that the whole document is,
    and the licenses that whole lines of it name, sorted and joined by commas (null without any).

    Each line is an entire text of the same scan. Lines that match are few and meet by id; rows
    that share an id share their statements, a null id is an id like others.
    """
    lines = docs.select(F.col(id_col).alias("__id"), F.explode(F.split(F.col(text_col), "\n")).alias("__line"))
    named = license_scan(lines, text_col="__line", known=known).filter("license_id is not null")
    named = named.groupBy("__id").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("statements"))
    whole = license_scan(docs.select(id_col, text_col), text_col=text_col, known=known)
    return whole.join(named, F.col(id_col).eqNullSafe(F.col("__id")), "left").select(
        id_col, "canonical_sha256", "license_id", "statements"
    )
