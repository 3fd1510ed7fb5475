import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.schemas import BRONZE_SUFFIX, FEEDS, MESSAGE_SCHEMA
from trendloom.sources.messages import file_stream
from trendloom.streaming.bronze import await_feeds, finish_feeds, parse_messages, start_append, start_feeds
from trendloom.streaming.dedup import first_seen_stream

AT = datetime(2024, 1, 15, 10)


def messages(spark, bodies, topic="hn-raw", at=AT):
    rows = [
        (str(i).encode(), b if b is None or isinstance(b, bytes) else json.dumps(b).encode(), topic, 0, i, at)
        for i, b in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_parse_types_drops_and_keeps(spark):
    rows = parse_messages(messages(spark, [
        {"id": 1, "title": "a", "score": 5, "kids": [1, 2], "time": 1705312800},
        {"id": 2, "title": "b", "score": "many"},
        {"id": 3, "score": 1},
        b"{broken", None, b"", b"[1, 2]",
    ]), FEEDS["hn"], AT)
    assert rows.schema.names == FEEDS["hn"].schema.names + BRONZE_SUFFIX.names
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {1, 2}
    assert got[1].score == 5 and got[1].kafka_topic == "hn-raw" and got[2].score is None


def test_required_fields_of_each_feed(spark):
    news = parse_messages(messages(spark, [{"article_id": "x"}, {"title": "t"}, {"article_id": "x", "title": "t"}]), FEEDS["news"])
    assert news.count() == 1
    github = parse_messages(messages(spark, [{"repo_id": 1, "topics": ["a"]}, {"repo_name": "r"}]), FEEDS["github"])
    assert [(r.repo_id, r.topics) for r in github.collect()] == [(1, ["a"])]


def test_json_is_parsed_once(spark):
    plan = parse_messages(messages(spark, [{"id": 1}]), FEEDS["hn"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_three_feeds_run_and_resume(spark, folder):
    bodies = {
        "hn": [{"id": 1, "title": "a"}, {"id": 2}],
        "news": [{"article_id": "n", "title": "t"}],
        "github": [{"repo_id": 9}],
    }

    def run():
        sources = {n: file_stream(spark, f"{folder}/in/{n}", max_files_per_trigger=1) for n in FEEDS}
        finish_feeds(start_feeds(sources, f"{folder}/bronze", f"{folder}/checkpoints", every=None))
        return {n: spark.read.parquet(f"{folder}/bronze/{n}").count() for n in FEEDS}

    for name, body in bodies.items():
        messages(spark, body).coalesce(1).write.parquet(f"{folder}/in/{name}")
    assert run() == {"hn": 1, "news": 1, "github": 1}
    assert run() == {"hn": 1, "news": 1, "github": 1}
    messages(spark, [{"id": 3, "title": "c"}]).coalesce(1).write.mode("append").parquet(f"{folder}/in/hn")
    assert run() == {"hn": 2, "news": 1, "github": 1}


def test_bronze_can_be_split_by_day(spark, folder):
    messages(spark, [{"id": 1, "title": "a"}]).write.parquet(f"{folder}/in")
    rows = parse_messages(file_stream(spark, f"{folder}/in"), FEEDS["hn"], AT)
    start_append(rows, f"{folder}/out", f"{folder}/cp", every=None, by_day=True).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").filter("ingest_day = '2024-01-15'").count() == 1


def test_first_seen_survives_a_restart(spark, folder):
    def run():
        rows = parse_messages(file_stream(spark, f"{folder}/in"), FEEDS["hn"])
        once = first_seen_stream(rows, "id", "kafka_timestamp", "7 days").select("id")
        start_append(once, f"{folder}/out", f"{folder}/cp", every=None).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect())

    story = [{"id": i, "title": "t"} for i in (1, 2, 1)]
    messages(spark, story).write.parquet(f"{folder}/in")
    assert run() == [1, 2]
    messages(spark, story + [{"id": 3, "title": "t"}]).write.mode("append").parquet(f"{folder}/in")
    assert run() == [1, 2, 3]


def test_one_ended_query_stops_the_others(spark, folder):
    for name in ("hn", "github"):
        messages(spark, [{"id": 1, "title": "a", "repo_id": 1}]).write.parquet(f"{folder}/in/{name}")
    sources = {n: file_stream(spark, f"{folder}/in/{n}") for n in ("hn", "github")}
    queries = start_feeds(sources, f"{folder}/bronze", f"{folder}/cp", every="1 second")
    for query in queries.values():
        query.processAllAvailable()
    queries["hn"].stop()
    await_feeds(spark, queries, check_seconds=1)
    assert not any(q.isActive for q in queries.values())
    assert spark.read.parquet(f"{folder}/bronze/github").count() == 1


def test_error_of_a_feed_is_raised(spark, folder):
    messages(spark, [{"id": 1, "title": "a"}]).write.parquet(f"{folder}/in")
    rows = file_stream(spark, f"{folder}/in").withColumn("value", F.raise_error(F.lit("boom")).cast("binary"))
    queries = start_feeds({"hn": rows}, f"{folder}/bronze", f"{folder}/cp", every="1 second")
    with pytest.raises(Exception, match="boom"):
        await_feeds(spark, queries, check_seconds=1)


@pytest.mark.parametrize("name", ["bronze_folded", "silver_stream"])
def test_every_trigger_has_a_file_for_each_core(spark, sf_dir, monkeypatch, name):
    from trendloom.registry import queries as registered

    asked = []

    def seen(session, path, **limits):
        asked.append((limits["max_files_per_trigger"], len(session.read.parquet(path).inputFiles())))
        return file_stream(session, path, **limits)

    monkeypatch.setattr(registered.messages, "file_stream", seen)
    registered.queries()[name](spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    assert asked and all(limit >= cores for limit, _ in asked)
    assert max(files for _, files in asked) >= 5 * cores  # several triggers, as before


def test_pieces_are_dealt_before_messages_are_made(spark, sf_dir):
    """In pieces the messages are the same; rows of the tables are shuffled once, messages never, and no task sorts for it."""
    from trendloom.registry import queries as registered

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    whole, dealt = registered.all_messages(spark, sf_dir), registered.all_messages(spark, sf_dir, 6)
    for feed in whole:
        assert dealt[feed].exceptAll(whole[feed]).count() == whole[feed].exceptAll(dealt[feed]).count() == 0
        plan = dealt[feed]._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan and "REPARTITION_BY_NUM" in plan and "to_json" not in plan.split("Exchange", 1)[1]
        assert dealt[feed].rdd.getNumPartitions() == 6
