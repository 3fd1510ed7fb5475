"""Retrieval over Gold: documents, vectors, nearest documents, context and prompt."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions._cols import ColumnLike, as_column
from trendloom.functions.numbers import fixed_text, rounded_text
from trendloom.operators.memory import TEXT, remembered
from trendloom.operators.models import EmbedderFactory, ResponderFactory, embed, respond
from trendloom.operators.numbering import number_rows
from trendloom.operators.vectors import cosine_topk
from trendloom.sources.tables import TableStore

# The texts and ids of the documents, and how much of each table is indexed.
CONTENT_TEXT = (
    "Source: %s. Title: %s. Description: %s. Author: %s. Popularity score: %s. "
    "Language: %s. Tags: %s. Published: %s."
)
TOPIC_TEXT = (
    "Trending topic: %s. Time window: %s. Mentioned %s times. Across %s different sources. "
    "Trend score: %s. Rank in this hour: %s. Example titles: %s."
)
LANGUAGE_TEXT = (
    "Programming language: %s. Day: %s. Momentum score: %s. Total stars: %s. "
    "Mentioned %s times. Across %s sources. Rank today: %s."
)
CONTENT_RANKS, TOPIC_RANKS, LANGUAGE_RANKS = 100, 20, 10
CONTEXT_SEPARATOR = "\n\n---\n\n"
RESULTS_PER_QUESTION = 8

EMBEDDING_SIZE = 256

INSTRUCTION = (
    "Below are records of a trend database, best match first, and a question about them. Reply in a "
    "few sentences that state figures from the records. Say plainly when they do not cover it.\n\n"
)


def _shown(value: ColumnLike, missing: str = "None") -> Column:
    return F.coalesce(as_column(value).cast("string"), F.lit(missing))


def _filled(value: ColumnLike, missing: str) -> Column:
    return F.coalesce(F.nullif(as_column(value), F.lit("")), F.lit(missing))


def _documents(df: DataFrame, doc_id: Column, text: Column, metadata: dict[str, Column]) -> DataFrame:
    pairs = [part for name, value in metadata.items() for part in (F.lit(name), value)]
    return df.select(
        doc_id.alias("id"), text.alias("text"), F.create_map(*pairs).alias("metadata")
    )


def content_documents(top_content: DataFrame, ranks: int = CONTENT_RANKS) -> DataFrame:
    chosen = top_content.filter(F.col("global_rank") <= ranks)
    numbered = number_rows(
        chosen, "global_rank", [F.col(c) for c in ("source", "title", "url", "author")], "_i"
    )
    none = F.array().cast("array<string>")
    text = F.format_string(
        CONTENT_TEXT,
        _shown("source"), _shown("title"), _filled("description", "N/A"),
        _filled("author", "unknown"), _shown("popularity_score"), _filled("language", "N/A"),
        F.array_join(F.coalesce("tags", none), ", "), _shown("published_at"),
    )
    rank = F.col("global_rank").cast("string")
    return _documents(
        numbered,
        F.concat(F.lit("content_"), F.col("_i").cast("string"), F.lit("_"), rank),
        text,
        {
            "type": F.lit("top_content"),
            "source": F.col("source"),
            "title": F.substring(F.coalesce("title", F.lit("")), 1, 100),
            "score": _shown("popularity_score"),
            "rank": rank,
            "language": F.coalesce("language", F.lit("")),
        },
    )


def topic_documents(trending: DataFrame, ranks: int = TOPIC_RANKS) -> DataFrame:
    chosen = trending.filter(F.col("rank_in_hour") <= ranks)
    numbered = number_rows(chosen, "hour_window", [F.col("rank_in_hour"), F.col("tag")], "_i")
    titles = F.array_join(F.slice(F.coalesce("sample_titles", F.array().cast("array<string>")), 1, 2), "; ")
    text = F.format_string(
        TOPIC_TEXT,
        F.col("tag"), _shown("hour_window"), _shown("mention_count"), _shown("source_diversity"),
        _shown(fixed_text("trend_score", 1)), _shown("rank_in_hour"), titles,
    )
    return _documents(
        numbered,
        F.concat(F.lit("trend_"), F.col("_i").cast("string"), F.lit("_"), F.col("tag")),
        text,
        {
            "type": F.lit("trending_topic"),
            "tag": F.col("tag"),
            "mentions": _shown("mention_count"),
            "diversity": _shown("source_diversity"),
            "score": _shown(rounded_text("trend_score", 2)),
            "window": _shown("hour_window"),
        },
    )


def language_documents(momentum: DataFrame, ranks: int = LANGUAGE_RANKS) -> DataFrame:
    chosen = momentum.filter(F.col("rank_by_day") <= ranks)
    numbered = number_rows(chosen, "day_window", [F.col("rank_by_day"), F.col("language")], "_i")
    day = _shown("day_window")
    text = F.format_string(
        LANGUAGE_TEXT,
        F.col("language"), day, _shown(fixed_text("momentum_score", 0)), _shown("total_stars"),
        _shown("mention_count"), _shown("source_diversity"), _shown("rank_by_day"),
    )
    return _documents(
        numbered,
        F.concat(
            F.lit("lang_"), F.col("_i").cast("string"), F.lit("_"), F.col("language"), F.lit("_"), day
        ),
        text,
        {
            "type": F.lit("language_momentum"),
            "language": F.col("language"),
            "momentum": _shown(rounded_text("momentum_score", 0)),
            "stars": _shown("total_stars"),
            "day": day,
        },
    )


def document_corpus(top_content: DataFrame, trending: DataFrame, momentum: DataFrame) -> DataFrame:
    return (
        content_documents(top_content)
        .unionByName(topic_documents(trending))
        .unionByName(language_documents(momentum))
    )


# ---- vectors ----------------------------------------------------------------------------


def hashed_embedding(
    df: DataFrame, text: str = "text", output: str = "embedding", size: int = EMBEDDING_SIZE
) -> DataFrame:
    """Offline default: counts of hashed words, of unit length, computed by Spark ML.

    Words are runs of letters and digits of any script, in lower case. A word's place is the number
    that the first eight hex digits of its MD5 spell, modulo ``size``.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    digits = len(f"{size - 1:x}")
    if size == 16**digits <= 16**8:  # the number modulo a power of 16 is its last digits, as they stand
        place = lambda w: F.substring(F.md5(w), 9 - digits, digits)
        names = [f"{k:0{digits}x}" for k in range(size)]
    else:
        place = lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % size).cast("string")
        names = [str(k) for k in range(size)]
    stage = df.withColumn("_places", F.transform(words, place))
    counts = CountVectorizerModel.from_vocabulary(names, "_places", "_counts")
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    for transformer in (counts, unit):
        stage = transformer.transform(stage)
    return stage.withColumn(output, vector_to_array("_unit", "float32")).drop("_places", "_counts", "_unit")


def embed_documents(
    df: DataFrame,
    embedder: EmbedderFactory | None = None,
    text: str = "text",
    output: str = "embedding",
    batch_size: int = 100,
) -> DataFrame:
    if embedder is None:
        return hashed_embedding(df, text, output)
    return df.withColumn(output, embed(embedder, F.col(text), batch_size))


def embed_remembered(
    df: DataFrame, memory: TableStore, model: str, embedder: EmbedderFactory | None = None, text: str = "text",
    output: str = "embedding",
) -> DataFrame:
    """The same as :func:`embed_documents`, with vectors kept in ``work/vectors`` of a store by model and text.

    Only texts without a kept vector are embedded, each once; a null text counts as empty.
    """
    def ask(given: DataFrame) -> DataFrame:
        return embed_documents(given, embedder, TEXT, output).drop(TEXT)

    return remembered(df, F.coalesce(F.col(text), F.lit("")), memory, "work", "vectors", ask, model)


# ---- answers ----------------------------------------------------------------------------


def contexts(hits: DataFrame, question_id: str = "question_id") -> DataFrame:
    """One context per question: its documents by place, each under its relevance and type.

    ``hits`` holds ``place``, ``similarity``, ``text`` and ``type``; a question has k of them.
    """
    share = rounded_text(F.col("similarity") * 100, 1)
    entry = F.concat(
        F.lit("["), share, F.lit("% relevant | "), F.coalesce("type", F.lit("unknown")), F.lit("]\n"),
        F.col("text"),
    )
    entries = F.sort_array(F.collect_list(F.struct("place", entry.alias("entry"))))
    return hits.groupBy(question_id).agg(entries.alias("_entries")).select(
        question_id, F.array_join(F.col("_entries.entry"), CONTEXT_SEPARATOR).alias("context")
    )


def prompts(
    contexts_df: DataFrame, questions: DataFrame, question_id: str = "question_id", instruction: str = INSTRUCTION
) -> DataFrame:
    """Instruction, context and question as one text per question."""
    asked = contexts_df.join(questions.select(question_id, "question"), question_id)
    return asked.withColumn("prompt", F.concat(
        F.lit(instruction), F.lit("=== DATA ===\n"), F.col("context"),
        F.lit("\n=== END OF DATA ===\n\nQuestion: "), F.col("question"), F.lit("\nAnswer:"),
    ))


def ask(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = RESULTS_PER_QUESTION,
    embedder: EmbedderFactory | None = None,
    responder: ResponderFactory | None = None,
    instruction: str = INSTRUCTION,
) -> DataFrame:
    """Questions (``question_id``, ``question``) to prompts over an embedded corpus, and to
    answers if a responder is given.
    """
    vectors = embed_documents(questions, embedder, "question")
    typed = corpus.withColumn("type", F.col("metadata")["type"])
    hits = cosine_topk(vectors, typed, k, carry=("text", "type"))
    ready = prompts(contexts(hits), questions, instruction=instruction)
    if responder is None:
        return ready
    answered = ready.withColumn("_answer", respond(responder, F.col("prompt")))
    return answered.select(
        *ready.columns,
        F.col("_answer.raw").alias("answer"),
        F.col("_answer.failure").alias("answer_error"),
    )
