"""Registered queries of this package against their SQL, and the pipeline stage by stage."""

import collections
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm.cases import DOCS
from tests.llm.test_table_operators import near_brute
from tests.llm.test_text_operators import judged
from tools.check import rows_of
from trendloom.llm import oracles, queries


@pytest.fixture(scope="module")
def tables():
    from tests.conftest import SF_DIR

    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, tables, name):
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    table = "pages" if name.startswith(("op3", "op7")) else "embeddings" if name.startswith("op13") else "documents"
    assert len(got) == tables.execute(f"select count(*) from {table}").fetchall()[0][0]
    if name in oracles.ORACLES:
        want = tables.execute(oracles.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir, tables):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = tables.execute("select item_id, text from benchmark").fetchall()
    before = [(r.doc_id, r.text) for r in docs.collect()]
    good = dict(tables.execute("select doc_id, quality from labels").fetchall())
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        assert out.columns[:5] == [f.name for f in DOCS]
        after = [(r.doc_id, r.text) for r in out.collect()]
        kept, gone = {i for i, _ in after}, [r for r in before if r not in set(after)]
        if number == 0:
            assert sum(good[i] for i, _ in gone if i in good) <= 1 and sum(1 - good[i] for i in kept if i in good) <= 3
        elif number == 1:
            first = {}
            for i, text in sorted(before):
                first.setdefault(" ".join(text.split()) if text.strip() == text else text, i)
            assert kept == set(first.values())
        elif number == 2:
            assert kept == {c for _, _, c in near_brute(before)}
        elif number == 3:
            assert {i for i, _ in gone} == {i for i, text in before if judged(text, items)[4]}
        else:
            assert after == before or collections.Counter(after) == collections.Counter(before)
            assert all(r.lossless and len(r.piece_ids) == r.n_pieces for r in out.collect())
        out.write.parquet(folder := f"/tmp/run-{spark.sparkContext.applicationId}-{number}")
        docs, before = spark.read.parquet(folder), after
