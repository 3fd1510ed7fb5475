"""Model-made sentiment, topics and entities for Silver rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions._cols import ColumnLike, as_column, columns_of
from trendloom.functions.sentiment import NEUTRAL
from trendloom.functions.text import not_blank
from trendloom.operators.memory import TEXT, remembered
from trendloom.operators.models import MESSAGE_LENGTH, ResponderFactory, respond
from trendloom.operators.settle import settle
from trendloom.plans.silver import drop_empty_titles, processing_time
from trendloom.schemas import AI_RESULT_SCHEMA
from trendloom.sources.tables import TableStore

# How many topics and entities are kept, the run's default size, and the names of
# the failures.
LIST_SIZE = 4
RUN_SIZE = 50
EMPTY_TITLE = "empty_title"
BAD_JSON = "json_parse_error"
NULL_LIST = "null_list"


def enrichment_candidates(
    tables: Iterable[DataFrame],
    enriched: DataFrame | None,
    size: int = RUN_SIZE,
    retry_errors: bool = False,
) -> DataFrame:
    """The most popular titled rows that have no enrichment yet.

    Ids and popularity alone decide. The at most ``size`` chosen ids are stored, and full rows are
    then picked by a semi join against them, so titles and descriptions take no part in the
    selection. With ``retry_errors`` rows whose enrichment failed count as not enriched.
    """
    titled = drop_empty_titles(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables))
    waiting = titled.select("unified_id", "popularity_score")
    if enriched is not None:
        done = enriched.filter(F.col("enrichment_error").isNull()) if retry_errors else enriched
        waiting = waiting.join(done.select("unified_id"), "unified_id", "left_anti")
    chosen = (
        waiting.orderBy(F.col("popularity_score").desc_nulls_last(), "unified_id")
        .limit(size)
        .select("unified_id")
    )
    return titled.join(settle(chosen)[0], "unified_id", "left_semi")


def prompt_text(
    title: ColumnLike = "title",
    description: ColumnLike = "description",
    max_chars: int | None = None,
) -> Column:
    """``title. description`` for the model, whole unless given a budget; null for a blank title."""
    whole = F.concat(as_column(title), F.lit(". "), F.coalesce(as_column(description), F.lit("")))
    return F.when(not_blank(title), whole if max_chars is None else F.substring(whole, 1, max_chars))


def response_body(raw: ColumnLike) -> Column:
    """The JSON in a model's answer, without surrounding blanks and code fences."""
    bare = F.regexp_replace(as_column(raw), r"^\s+|\s+$", "")
    fenced = F.regexp_extract(bare, r"(?s)^```(?:json)?(.*?)(?:```|$)", 1)
    return F.when(bare.startswith("```"), fenced).otherwise(bare)


def parse_responses(
    asked: DataFrame, raw: str, failure: str, blank: Column, list_size: int | None = LIST_SIZE
) -> DataFrame:
    """Replace an answer and its failure by ``sentiment``, ``ai_topics``, ``ai_entities`` and
    ``enrichment_error``. Any error leaves neutral and empty lists.

    An answer is in error unless it is a JSON object, and if it gives null for a list. A single
    value in the place of a list is a list of that value. Of a repeated name the last value counts.
    ``list_size`` entries of each list are kept, all of them for None.
    """
    kept = [c for c in asked.columns if c not in (raw, failure)]
    body = F.struct(response_body(raw).alias("_body"), blank.alias("_blank"))
    trimmed = asked.select(*kept, failure, columns_of(body))
    # In brackets, so that text behind the object or a second object is an error.
    listed = F.from_json(F.concat(F.lit("["), F.col("_body"), F.lit("]")), "array<map<string,string>>")
    read = F.struct(listed.alias("_listed"), F.from_json("_body", AI_RESULT_SCHEMA).alias("_fields"))
    whole = F.when(F.size("_listed") == 1, F.map_entries(F.col("_listed")[0]))
    opened = trimmed.select(*kept, failure, "_blank", columns_of(read)).withColumn("_given", whole)

    def given(name: str) -> Column:
        """Entries of a name; the last one counts."""
        return F.filter("_given", lambda pair: pair["key"] == name)

    def last(name: str) -> Column:
        return F.try_element_at(given(name), F.lit(-1))["value"]

    no_object = F.col("_given").isNull()
    null_list = reduce(
        lambda a, b: a | b, [(F.size(given(n)) > 0) & last(n).isNull() for n in ("ai_topics", "entities")]
    )
    error = (
        F.when(F.col("_blank"), F.lit(EMPTY_TITLE))
        .when(F.col(failure).isNotNull(), F.col(failure))
        .when(no_object, F.lit(BAD_JSON))
        .when(null_list, F.lit(NULL_LIST))
    )
    parsed = opened.withColumn("_error", error)
    good = F.col("_error").isNull()

    def items(name: str) -> Column:
        found = F.coalesce(F.col("_fields")[name], F.when(last(name).isNotNull(), F.array(last(name))))
        found = F.coalesce(F.when(good, found), F.array().cast("array<string>"))
        return found if list_size is None else F.slice(found, 1, list_size)

    return parsed.select(
        *kept,
        F.coalesce(F.when(good, F.col("_fields.sentiment")), F.lit(NEUTRAL)).alias("sentiment"),
        items("ai_topics").alias("ai_topics"),
        items("entities").alias("ai_entities"),
        F.col("_error").alias("enrichment_error"),
    )


def enrich(
    rows: DataFrame,
    enricher: ResponderFactory | None = None,
    model: str = "lexicon",
    max_chars: int | None = None,
    pause_seconds: float = 0.0,
    parallel_calls: int | None = None,
    as_of: datetime | None = None,
    template: str = "%s",
    list_size: int | None = LIST_SIZE,
    retries: int = 0,
    backoff_seconds: float = 1.0,
    breaker: int | None = None,
    memory: TableStore | None = None,
) -> DataFrame:
    """Ask the model about every row and add the typed result. Parsing stays in built-in functions.

    The model gets the whole text in the place of ``%s`` in ``template``; ``max_chars`` cuts the
    text to a budget. ``parallel_calls`` is the number of tasks, each with its own client, and so
    the bound on calls at a time. Without it there are as many as the plan's last stage has tasks,
    which suits a local model only. The default without ``enricher`` needs no model and no Python.

    ``retries``, ``backoff_seconds`` and ``breaker`` are those of :func:`trendloom.operators.models.respond`.
    With ``memory`` answers are kept in that store's ``work/answers`` by model and text, and only texts
    without one are sent; failures are not kept.
    """
    text = prompt_text(max_chars=max_chars)
    if enricher is None:
        answered = with_lexicon(rows, text, list_size)
    else:
        before, _, after = template.partition("%s")
        sent = F.concat(F.lit(before), text, F.lit(after))

        def ask(given: DataFrame, question: Column) -> DataFrame:
            spread = given.repartition(parallel_calls) if parallel_calls else given
            answer = respond(enricher, question, pause_seconds, MESSAGE_LENGTH, retries, backoff_seconds, breaker)
            return spread.withColumn("_answer", answer).select(
                *given.columns, F.col("_answer.raw").alias("_raw"), F.col("_answer.failure").alias("_failure")
            )

        if memory is None:
            asked = ask(rows, sent)
        else:
            asked = remembered(
                rows, sent, memory, "work", "answers", lambda given: ask(given, F.col(TEXT)).drop(TEXT), model,
                F.col("_failure").isNull(),
            )
        answered = parse_responses(asked, "_raw", "_failure", ~not_blank("title"), list_size)
    return answered.withColumns({"enriched_at": processing_time(as_of), "llm_model": F.lit(model)})


# ---- offline default --------------------------------------------------------------------

POSITIVE_WORDS = tuple("best better fast faster good great improved love new open safe success win".split())
NEGATIVE_WORDS = tuple("attack bad breach broken bug crash down error fail failed lost slow worse".split())
TOPIC_WORDS = ("ai", "cloud", "data", "database", "kubernetes", "learning", "python", "rust", "security", "web")




def _any_of(words: Iterable[str]) -> str:
    """Pattern of words that stand alone. It branches on the first letter, so that few are tried at each place."""
    branches = [f"{first}(?:{'|'.join(w[1:] for w in group)})" for first, group in groupby(sorted(words), lambda w: w[0])]
    return f"(?<![a-z])(?:{'|'.join(branches)})(?![a-z])"


_KNOWN = _any_of({*POSITIVE_WORDS, *NEGATIVE_WORDS, *TOPIC_WORDS})


def with_lexicon(rows: DataFrame, text: Column, list_size: int | None = LIST_SIZE) -> DataFrame:
    """``rows`` and the result columns of :func:`enrich` from known words; a null text is an empty title.

    The known words of a text are found once and behind a generator, so none of the counts below
    searches the text again. They are few, however long the text is.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(_KNOWN), 0)
    opened = rows.select("*", columns_of(F.struct(found.alias("_words"))))
    words = F.col("_words")
    count = lambda known: F.size(F.filter(words, lambda w: w.isin(*known)))
    mood = count(POSITIVE_WORDS) - count(NEGATIVE_WORDS)
    topics = F.filter(F.array(*map(F.lit, TOPIC_WORDS)), lambda t: F.array_contains(words, t))
    topics = topics if list_size is None else F.slice(topics, 1, list_size)
    none = F.array().cast("array<string>")
    return opened.select(
        *[f"`{c}`" for c in rows.columns],
        F.when(words.isNull() | (mood == 0), NEUTRAL).when(mood > 0, "positive").otherwise("negative").alias("sentiment"),
        F.when(words.isNull(), none).otherwise(topics).alias("ai_topics"),
        none.alias("ai_entities"),
        F.when(words.isNull(), EMPTY_TITLE).alias("enrichment_error"),
    )
