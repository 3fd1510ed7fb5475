"""Every registered query against its SQL, and the jobs end to end."""

import threading
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of
from trendloom.plans import gold, jobs
from trendloom.registry import oracles
from trendloom.registry import queries as registered
from trendloom.registry.queries import warehouse
from trendloom.schemas import FEEDS
from trendloom.sources import testdata
from trendloom.sources.tables import TableStore

QUERIES, ORACLES = registered.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    from tests.conftest import SF_DIR

    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns[:3] == ["hour_window", "source", "item_count"]
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = tables.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_jobs_from_bronze_to_documents(spark, sf_dir, folder):
    store = TableStore(spark, folder, "parquet")
    assert jobs.run_silver(store) == {"hn": 0, "news": 0, "github": 0}
    stamped = "cast('2024-02-01' as timestamp) as bronze_ingested_at"
    for feed, raw in testdata.RAW.items():
        store.append(raw(spark, sf_dir).selectExpr("*", stamped), "bronze", feed)
    first = jobs.run_silver(store, as_of=datetime(2024, 2, 1))
    assert all(first.values())
    again = jobs.run_silver(store, since=datetime(2024, 2, 2))
    assert again == {"hn": 0, "news": 0, "github": 0}
    assert {f: store.read("silver", f).count() for f in FEEDS} == first
    assert jobs.run_enrichment(store, size=20, parallel_calls=2) == 20
    counts = jobs.run_gold(store, testdata.AS_OF)
    assert counts == jobs.run_gold(store, testdata.AS_OF)
    assert all(counts.values())
    assert "description" not in store.read("work", "combined").columns
    told = lambda df: sorted((r.global_rank, str(r.title), str(r.description), str(r.url)) for r in df.collect())
    whole = gold.top_content(jobs.load_combined(store), testdata.AS_OF)
    assert told(store.read("gold", "top_content")) == told(whole) and whole.filter("description is not null").count() > 0
    told = jobs.report(store)
    assert {r["table"]: r["rows"] for r in told["rows"]}["silver/hn"] == first["hn"]
    assert told["errors"] == [{"total": 20, "errors": 0, "error_pct": 0.0}] and told["hn rows without id"] == [{"rows": 0}]
    assert store.compact("silver", "hn") == first["hn"]
    assert jobs.run_retrieval(store) == store.read("gold", "documents").count() > 0
    questions = spark.createDataFrame([("1", "What about rust?"), ("2", "")], "question_id string, question string")
    assert jobs.run_questions(store, questions) == store.read("gold", "answers").count() == 2


def test_gold_reads_only_the_columns_it_needs(spark, sf_dir):
    combined = jobs.load_combined(warehouse(spark, sf_dir, "silver"))
    plan = jobs.BUILDERS["source_activity"](combined)._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split("\n")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert schemas and not any("description" in s or "title" in s for s in schemas)


def test_silver_feeds_are_written_side_by_side(spark, sf_dir, folder, monkeypatch):
    """Each feed waits for all others to have begun, which fails if they are written one after another."""
    begun, real = threading.Barrier(len(FEEDS), timeout=30), TableStore.upsert

    def upsert(self, *args):
        begun.wait()
        return real(self, *args)

    monkeypatch.setattr(TableStore, "upsert", upsert)
    store = TableStore(spark, folder, "parquet")
    registered._write_silver(store, sf_dir)
    assert all(store.read("silver", name).count() for name in (*FEEDS, "enriched"))
