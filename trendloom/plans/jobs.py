"""Batch jobs over a table store: Silver, enrichment, Gold, retrieval documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators.models import NOT_ASKED, EmbedderFactory, ResponderFactory
from trendloom.plans import enrich, gold, metrics, retrieval
from trendloom.plans.silver import map_feed, moment, to_silver
from trendloom.schemas import FEEDS, INGEST_DAY
from trendloom.sources.tables import TableStore

BUILDERS = {
    "trending_topics": gold.trending_topics,
    "language_momentum": gold.language_momentum,
    "source_activity": gold.source_activity,
    "top_content": gold.top_content,
}


def run_silver(
    store: TableStore,
    feeds: Iterable[str] = tuple(FEEDS),
    since: datetime | None = None,
    as_of: datetime | None = None,
) -> dict[str, int]:
    """Bronze to Silver by keyed upsert; returns rows upserted per feed.

    A feed without a Bronze table is skipped with 0. ``since`` reads only what arrived after the
    last run instead of the whole history; a Bronze table split by day is pruned to those days.
    """

    def run(feed: str) -> int:
        bronze = store.read_if_exists("bronze", feed)
        if bronze is None:
            return 0
        if since is not None:
            bronze = bronze.filter(F.col("bronze_ingested_at") >= moment(since))
            if INGEST_DAY in bronze.columns:
                bronze = bronze.filter(F.col(INGEST_DAY) >= moment(since).cast("date"))
        rows = to_silver(bronze, feed, as_of)
        return store.upsert(rows, "silver", feed, "unified_id")

    return side_by_side({feed: partial(run, feed) for feed in feeds})


def side_by_side(tasks: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent jobs from several threads, so that one fills the gaps of another.

    The first error is raised once all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
    return {name: job.result() for name, job in running.items()}


def silver_tables(store: TableStore) -> list[DataFrame]:
    found = [store.read_if_exists("silver", feed) for feed in FEEDS]
    tables = [df for df in found if df is not None]
    if not tables:
        raise FileNotFoundError(f"no Silver tables under {store.root}; run the Silver job first")
    return tables


def load_combined(store: TableStore) -> DataFrame:
    return gold.combine_silver(silver_tables(store), store.read_if_exists("silver", "enriched"), kept_by_id(store))


def kept_by_id(store: TableStore) -> bool:
    """All Silver tables are upserted by id; the feed is part of what an id is made of."""
    return all(store.kept_by("silver", feed) == "unified_id" for feed in FEEDS if store.exists("silver", feed))


def run_enrichment(
    store: TableStore,
    enricher: ResponderFactory | None = None,
    model: str = "lexicon",
    size: int = enrich.RUN_SIZE,
    retry_errors: bool = False,
    max_chars: int | None = None,
    pause_seconds: float = 0.0,
    parallel_calls: int | None = None,
    as_of: datetime | None = None,
    target: TableStore | None = None,
    template: str = "%s",
    list_size: int | None = enrich.LIST_SIZE,
    retries: int = 0,
    backoff_seconds: float = 1.0,
    breaker: int | None = None,
    remember: bool = False,
) -> int:
    """Enrich the next ``size`` rows and append them; returns rows written.

    Selection, model calls and write are one job, so the rows asked about are the rows stored. Rows that
    an open ``breaker`` kept from being asked are not stored: the next run takes them again. With
    ``remember`` a text that has an answer of the model is not sent again.
    """
    target = target or store
    waiting = enrich.enrichment_candidates(
        silver_tables(store), target.read_if_exists("silver", "enriched"), size, retry_errors
    )
    rows = enrich.enrich(
        waiting, enricher, model, max_chars, pause_seconds, parallel_calls, as_of, template, list_size,
        retries, backoff_seconds, breaker, target if remember else None,
    )
    if breaker is not None:
        rows = rows.filter(~F.col("enrichment_error").eqNullSafe(F.lit(NOT_ASKED)))
    return target.append(rows, "silver", "enriched")


def run_gold(
    store: TableStore, as_of: datetime | None = None, target: TableStore | None = None
) -> dict[str, int]:
    """Recompute all Gold tables; returns rows per table.

    The combined rows are written once and read by each builder with only the columns it needs.
    Descriptions, urls and authors are looked up for the leaders of the leaderboard alone. A written
    table outlives lost executors, which cached blocks would not.
    """
    target = target or store
    target.overwrite(gold.for_builders(load_combined(store)), "work", "combined")
    combined = target.read("work", "combined")

    def texts(ids: DataFrame) -> DataFrame:
        """What the leaders show besides, of a few ids; the semi join reaches the Silver tables."""
        few = [table.join(ids, "unified_id", "left_semi") for table in silver_tables(store)]
        return gold.combine_silver(few, unique=kept_by_id(store)).select("unified_id", *gold.LOOKED_UP)

    def run(name: str) -> int:
        options = {"texts": texts} if name == "top_content" else {}
        return target.overwrite(BUILDERS[name](combined, as_of, **options), "gold", name)

    return side_by_side({name: partial(run, name) for name in BUILDERS})


def report(store: TableStore) -> dict[str, list[dict]]:
    """Counts that describe the stored tables: rows per table, sentiments and error rate of the
    enrichment, and Bronze rows that Silver leaves out because they have no id.
    """
    names = [*(("bronze", f) for f in FEEDS), *(("silver", f) for f in (*FEEDS, "enriched")), *(("gold", b) for b in BUILDERS)]
    tables = {f"{layer}/{name}": store.read_if_exists(layer, name) for layer, name in names}
    found = {"rows": metrics.layer_counts(store.spark, tables)}
    enriched = tables["silver/enriched"]
    if enriched is not None:
        found["errors"] = metrics.enrichment_errors(enriched)
        if "source" in enriched.columns:
            found["sentiments"] = metrics.sentiment_distribution(enriched)
    for feed in FEEDS:
        if (bronze := tables[f"bronze/{feed}"]) is not None:
            found[f"{feed} rows without id"] = metrics.rows_without_id(map_feed(bronze, feed))
    return {name: [row.asDict() for row in df.collect()] for name, df in found.items()}


def run_questions(
    store: TableStore,
    questions: DataFrame,
    embedder: EmbedderFactory | None = None,
    responder: ResponderFactory | None = None,
    k: int = retrieval.RESULTS_PER_QUESTION,
) -> int:
    """Ask a table of questions (``question_id``, ``question``) of the embedded documents; prompts,
    and answers if a responder is given, are appended to ``gold/answers``. Returns questions asked.
    """
    asked = retrieval.ask(questions, store.read("gold", "documents"), k, embedder, responder)
    return store.append(asked, "gold", "answers")


def run_retrieval(store: TableStore, embedder: EmbedderFactory | None = None, model: str | None = None) -> int:
    """Rebuild the embedded documents from the Gold tables; returns documents written.

    With the name of the ``model`` its vectors are kept in ``work/vectors`` by text, and only texts that
    are new since the last rebuild are embedded.
    """
    documents = retrieval.document_corpus(
        store.read("gold", "top_content"),
        store.read("gold", "trending_topics"),
        store.read("gold", "language_momentum"),
    )
    if model is None:
        embedded = retrieval.embed_documents(documents, embedder)
    else:
        embedded = retrieval.embed_remembered(documents, store, model, embedder)
    return store.overwrite(embedded, "gold", "documents")
