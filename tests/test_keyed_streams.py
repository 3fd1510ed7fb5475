"""Streams into keyed tables, folded files, pinned versions, Gold by changed days, slices and stream metrics."""

import json
import os
import time
from datetime import date, datetime, timedelta
from glob import glob

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import messages
from trendloom.plans import gold, jobs, metrics, refresh, silver
from trendloom.plans.silver import to_silver
from trendloom.schemas import FEEDS, SILVER_SCHEMA
from trendloom.session import REMOVE_SHUFFLES
from trendloom.sources import testdata
from trendloom.sources.messages import file_stream
from trendloom.sources.tables import TableStore
from trendloom.streaming import keyed, slices, watch
from trendloom.streaming.bronze import finish_feeds, parse_messages, start_append, start_feeds

AT = datetime(2024, 1, 15, 10)


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, folder, "parquet")


def frame(spark, rows, schema="k string, v int, at int"):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def parts(store, layer, name):
    return store._version(store.path(layer, name))[1]["parts"]


# ---- batches of a stream --------------------------------------------------------------------


def test_a_batch_is_applied_once(spark, store):
    first, again = frame(spark, [("a", 1, 1)]), frame(spark, [("a", 9, 9)])
    assert store.upsert(first, "silver", "t", "k", batch=("s", 0)) == 1
    assert store.upsert(again, "silver", "t", "k", batch=("s", 0)) == 0
    assert store.version("silver", "t") == 1 and content(store.read("silver", "t")) == [("a", 1, 1)]
    assert store.upsert(again, "silver", "t", "k", batch=("other", 0)) == 1  # another stream counts for itself
    assert store.upsert(frame(spark, []), "silver", "t", "k", batch=("s", 1)) == 0
    assert store.upsert(first, "silver", "t", "k", batch=("s", 1)) == 0  # an empty batch is a batch
    store.compact("silver", "t")
    assert store.upsert(first, "silver", "t", "k", batch=("s", 1)) == 0 and content(store.read("silver", "t")) == [("a", 9, 9)]
    assert [store.append(first, "bronze", "b", batch=("s", n)) for n in (0, 0, 1, 1)] == [1, 0, 1, 0]


def test_with_a_stamp_the_order_of_writing_does_not_matter(spark, store):
    rows = [("a", 1, 1), ("a", 2, 2), ("b", 1, 5), ("b", 0, 4), ("c", 7, None), ("c", 8, 1), ("d", 3, 3), ("d", 4, 3)]
    for name, order in (("x", rows), ("y", rows[::-1])):
        for row in order:
            store.upsert(frame(spark, [row]), "silver", name, "k", stamp="at")
        store.fold("silver", name, 3)
        assert content(store.read("silver", name)) == [("a", 2, 2), ("b", 1, 5), ("c", 8, 1), ("d", 4, 3)]
    with pytest.raises(ValueError, match="kept by"):
        store.upsert(frame(spark, [rows[0]]), "silver", "x", "k")


def story(i, title, score, at):
    return {"id": i, "title": title, "score": score, "source": "hackernews", "ingested_at": at, "time": 1705312800}


def silver_run(spark, store, folder, **options):
    source = file_stream(spark, f"{folder}/in", max_files_per_trigger=1)
    finish_feeds(keyed.start_silver({"hn": source}, store, f"{folder}/cp", AT, every=None, **options))


def test_silver_follows_the_stream(spark, store, folder):
    late, early = "2024-01-15T10:00:00+00:00", "2024-01-15T09:00:00+00:00"
    bodies = [[story(1, " a  b", 5, late)], [story(1, "older", 9, early), story(2, "two", 1, early)], [{"id": 3}, story(2, " ", 7, late), story(4, "four", 0, early)]]
    for body in bodies:
        messages(spark, body).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        silver_run(spark, store, folder, fan=2)
    got = {r.title: r.popularity_score for r in store.read("silver", "hn").collect()}
    assert got == {"a b": 5, "two": 1, "four": 0}  # a message that comes late replaces nothing newer
    every = [b for body in bodies for b in body]
    want = to_silver(parse_messages(messages(spark, every), FEEDS["hn"], AT), "hn", AT)
    assert content(store.read("silver", "hn")) == content(want)
    assert len(parts(store, "silver", "hn")) <= 2


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {path for folder in folders for path in glob(f"{folder.getPath()}/*/shuffle_*.data")}


def until(holds, seconds=20):
    """What Spark does in the background has that long."""
    end = time.time() + seconds
    while not holds() and time.time() < end:
        time.sleep(0.1)
    return holds()


def test_triggers_leave_no_shuffle_files_and_no_messages(spark, store, folder):
    for k in range(4):
        body = [story(i, f"t{i}", k, f"2024-01-15T1{k}:00:00+00:00") for i in range(50)]
        messages(spark, body).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    setting, before = spark.conf.get(REMOVE_SHUFFLES), shuffle_files(spark)
    source = file_stream(spark, f"{folder}/in", max_files_per_trigger=1, once=True)
    finish_feeds(keyed.start_silver({"hn": source}, store, f"{folder}/cp", AT, every=None, fan=3))
    assert until(lambda: not shuffle_files(spark) - before)
    assert until(lambda: len(glob(f"{folder}/in/*.parquet")) <= 1)  # that of the last trigger
    assert spark.conf.get(REMOVE_SHUFFLES) == setting
    assert [r.popularity_score for r in store.read("silver", "hn").collect()] == [3] * 50


def test_a_fold_of_a_keyed_table_is_one_shuffle(spark, store, monkeypatch):
    for k in range(3):
        store.upsert(frame(spark, [("a", k, k), (f"n{k}", k, k)]), "silver", "t", "k", "at")
    plans, part = [], TableStore._part

    def seen(self, df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return part(self, df, path)

    monkeypatch.setattr(TableStore, "_part", seen)
    assert store.fold("silver", "t", 3) == 3
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
    assert content(store.read("silver", "t")) == [("a", 2, 2), ("n0", 0, 0), ("n1", 1, 1), ("n2", 2, 2)]


def test_driver_lost_between_commit_and_checkpoint(spark, store, folder, monkeypatch):
    """The write is committed, then the driver dies before Spark notes the batch: it comes again."""
    messages(spark, [story(1, "a", 5, "2024-01-15T10:00:00+00:00")]).coalesce(1).write.parquet(f"{folder}/in")
    upsert, calls = TableStore.upsert, []

    def dying(self, *args, **options):
        calls.append(upsert(self, *args, **options))
        if len(calls) == 1:
            raise RuntimeError("driver lost")
        return calls[-1]

    monkeypatch.setattr(TableStore, "upsert", dying)
    with pytest.raises(Exception, match="driver lost"):
        silver_run(spark, store, folder)
    assert store.version("silver", "hn") == 1 and not glob(f"{folder}/cp/hn/commits/*")
    silver_run(spark, store, folder)
    assert calls == [1, 0] and store.version("silver", "hn") == 1 and store.read("silver", "hn").count() == 1
    assert glob(f"{folder}/cp/hn/commits/0")
    # A new checkpoint is a new stream: its batch 0 is not taken for the old one.
    source = file_stream(spark, f"{folder}/in")
    finish_feeds(keyed.start_silver({"hn": source}, store, f"{folder}/cp2", AT, every=None))
    assert calls == [1, 0, 1] and store.read("silver", "hn").count() == 1


def test_driver_lost_before_the_commit(spark, store, folder, monkeypatch):
    messages(spark, [story(1, "a", 5, "2024-01-15T10:00:00+00:00")]).coalesce(1).write.parquet(f"{folder}/in")
    commit = TableStore._commit

    def dying(*args):
        monkeypatch.setattr(TableStore, "_commit", commit)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(TableStore, "_commit", dying)
    with pytest.raises(Exception, match="driver lost"):
        silver_run(spark, store, folder)
    assert not store.exists("silver", "hn")
    silver_run(spark, store, folder)
    assert store.read("silver", "hn").count() == 1 and len(glob(f"{store.path('silver', 'hn')}/part-*")) == 1  # the lost part is swept


# ---- folded parts and files -----------------------------------------------------------------


def test_folding_bounds_the_parts_and_keeps_the_rows(spark, store):
    want, most = {}, 0
    for k in range(40):
        rows = [(f"k{k % 7}", k, k), (f"n{k}", k, k)]
        want |= {r[0]: r for r in rows}
        store.upsert(frame(spark, rows), "silver", "t", "k")
        store.append(frame(spark, rows), "bronze", "t")
        for layer in ("silver", "bronze"):
            store.fold(layer, "t", 3)
            most = max(most, len(parts(store, layer, "t")))
    assert most <= 2 * 4 + 1  # under three a level, four levels for forty parts
    assert content(store.read("silver", "t")) == content(frame(spark, list(want.values())))
    assert store.read("bronze", "t").count() == 80
    levels = [a["level"] for p, a in store._version(store.path("silver", "t"))[1]["about"].items()]
    assert max(levels) == 3 and len(glob(f"{store.path('silver', 't')}/part-*")) <= 2 * most


def test_folded_stream_reads_the_same_before_during_and_after(spark, store, folder, monkeypatch):
    def run(k):
        messages(spark, [{"id": 10 * k + i, "title": "t"} for i in range(4)]).repartition(4).write.mode("append").parquet(f"{folder}/in")
        finish_feeds(start_feeds({"hn": file_stream(spark, f"{folder}/in", max_files_per_trigger=1)}, f"{folder}/bronze", f"{folder}/cp", every=None))

    ids = lambda: sorted(r.id for r in store.read("bronze", "hn").select("id").collect())
    want = []
    for k in range(4):
        run(k)
        want += [10 * k + i for i in range(4)]
        assert ids() == want
        if k == 1:  # the job is lost after it wrote its part: the version before still holds
            commit = TableStore._commit
            monkeypatch.setattr(TableStore, "_commit", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                store.fold_stream("bronze", "hn", fan=2)
            monkeypatch.setattr(TableStore, "_commit", commit)
            assert ids() == want
        during = store.read("bronze", "hn")
        assert store.fold_stream("bronze", "hn", fan=2) > 0
        assert ids() == want == sorted(r.id for r in during.select("id").collect())
        assert store.fold_stream("bronze", "hn", fan=2) == 0
    opened = store.read("bronze", "hn").inputFiles()
    assert all("/part-" in f.split("bronze/hn")[1][:7] for f in opened) and len(opened) <= 4
    plain = spark.read.parquet(f"{folder}/bronze/hn")  # the sink's own log still tells all
    assert plain.count() == len(want) and len(plain.inputFiles()) > len(opened)
    with pytest.raises(ValueError, match="appending"):
        store.append(plain, "bronze", "hn")


def test_files_of_an_unfinished_batch_are_not_folded(spark, store, folder):
    messages(spark, [{"id": 1, "title": "a"}]).write.parquet(f"{folder}/in")
    rows = parse_messages(file_stream(spark, f"{folder}/in"), FEEDS["hn"], AT)
    start_append(rows, f"{folder}/bronze/hn", f"{folder}/cp", every=None, by_day=True).awaitTermination()
    day = glob(f"{folder}/bronze/hn/ingest_day=*")[0]
    spark.read.parquet(f"{folder}/bronze/hn").drop("ingest_day").write.mode("append").parquet(day)  # not in the log
    assert store.read("bronze", "hn").count() == 1
    assert store.fold_stream("bronze", "hn") == 1
    table = store.read("bronze", "hn")
    assert table.count() == 1 and table.filter("ingest_day = '2024-01-15'").count() == 1


def test_files_that_the_log_forgot_are_deleted(spark, store, folder, monkeypatch):
    messages(spark, [{"id": i, "title": "a"} for i in range(3)]).repartition(3).write.parquet(f"{folder}/in")
    finish_feeds(start_feeds({"hn": file_stream(spark, f"{folder}/in", max_files_per_trigger=1)}, f"{folder}/bronze", f"{folder}/cp", every=None))
    files = lambda: glob(f"{folder}/bronze/hn/part-*.parquet")
    store.fold_stream("bronze", "hn")
    n, listed = len(files()), TableStore._listed
    gone = sorted(listed(store, store.path("bronze", "hn")))[0]
    monkeypatch.setattr(TableStore, "_listed", lambda self, path: listed(self, path) - {gone})
    messages(spark, [{"id": 9, "title": "a"}]).write.mode("append").parquet(f"{folder}/in")
    finish_feeds(start_feeds({"hn": file_stream(spark, f"{folder}/in")}, f"{folder}/bronze", f"{folder}/cp", every=None))
    before = len(files())
    store.fold_stream("bronze", "hn")
    assert len(files()) == before - 1 and before > n
    assert sorted(r.id for r in store.read("bronze", "hn").collect()) == [0, 1, 2, 9]


# ---- reads that skip parts, pinned versions -------------------------------------------------


def test_reads_skip_parts_by_key_range_and_condition(spark, store):
    for k in range(5):
        store.upsert(frame(spark, [(f"k{k}{i}", k, i) for i in range(10)]), "silver", "t", "k")
    few = store.read_keys("silver", "t", "k30", "k35")
    assert few.count() == 6 and len({os.path.dirname(f) for f in few.inputFiles()}) == 1
    assert store.read_keys("silver", "t", "x", "y").count() == 0
    store.upsert(frame(spark, [("k11", 50, 50)]), "silver", "t", "k")
    assert content(store.read_keys("silver", "t", "k11", "k11")) == [("k11", 50, 50)]
    for condition in (F.col("v") == 1, F.col("v") > 3, F.col("at") == 50, F.lit(False)):
        assert content(store.read_where("silver", "t", condition)) == content(store.read("silver", "t").filter(condition))
    plan = store.read_where("silver", "t", F.col("v") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,1)" in plan


def test_pinned_versions_stay_until_the_next_pin(spark, store):
    store.upsert(frame(spark, [("a", 1, 1)]), "silver", "t", "k")
    assert store.pin("job", [("silver", "t"), ("silver", "absent")]) == {"silver/t": 1}
    for k in range(2, 6):
        store.upsert(frame(spark, [("a", k, k)]), "silver", "t", "k")
        store.compact("silver", "t")
    assert content(store.read("silver", "t", version=1)) == [("a", 1, 1)] and content(store.read("silver", "t")) == [("a", 5, 5)]
    store.pin("job", [("silver", "t")])
    store.compact("silver", "t")
    store.compact("silver", "t")
    assert store.written_since("silver", "t", 1) is None and store.read("silver", "t").count() == 1


def test_replaced_versions_are_kept_for_long_reads(spark, folder):
    store = TableStore(spark, folder, "parquet", keep_seconds=600)
    store.append(frame(spark, [("a", 1, 1)]), "bronze", "t")
    long_read = store.read("bronze", "t")
    for k in range(6):
        store.append(frame(spark, [("b", k, k)]), "bronze", "t")
        store.fold("bronze", "t", 2)
    assert long_read.count() == 1 and store.read("bronze", "t").count() == 7
    store.keep_seconds = 0
    store.append(frame(spark, [("c", 1, 1)]), "bronze", "t")
    assert len(glob(f"{store.path('bronze', 't')}/_versions/0*")) == 2


# ---- Gold by changed days -------------------------------------------------------------------


def item(i, at, score=1, tags=("rust", "x1"), source="hackernews", title="t"):
    return (i, source, title, f"about {i}", None, None, score, list(tags), "go" if source == "github" else None, at, AT, AT, "1")


def items(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


ENRICHED = "unified_id string, sentiment string, ai_topics array<string>, ai_entities array<string>, enrichment_error string, enriched_at timestamp"


def same_gold(store, spark):
    full = TableStore(spark, f"{store.root}/full-{time.time()}", "parquet")
    jobs.run_gold(store, AT, target=full)
    for name in jobs.BUILDERS:
        assert content(store.read("gold", name)) == content(full.read("gold", name)), name


def test_refresh_is_a_full_run(spark, store):
    day = lambda d, h=10: datetime(2024, 1, d, h)
    store.upsert(items(spark, [item("a", day(10)), item("b", day(10, 11), 5), item("c", day(12)), item("d", None), item("e", day(14))]), "silver", "hn", "unified_id")
    store.upsert(items(spark, [item("g", day(11), 90, source="github"), item("h", None, 50, source="github")]), "silver", "github", "unified_id")
    store.append(spark.createDataFrame([("a", "positive", ["x"], [], None, AT)], ENRICHED), "silver", "enriched")
    refresh.refresh_gold(store, AT)
    same_gold(store, spark)
    files = lambda: {d: f for d, f in store._version(store.path("gold", "source_activity"))[1]["days"].items()}
    before = files()
    assert sorted(before) == ["day=2024-01-10", "day=2024-01-11", "day=2024-01-12", "day=2024-01-14"]

    # b moves to another hour, c to another day (its old day is empty then), g loses its time, e and f come.
    store.upsert(items(spark, [item("b", day(10, 12), 6), item("c", day(13)), item("f", day(14), 7, ("python",))]), "silver", "hn", "unified_id")
    store.upsert(items(spark, [item("g", None, 95, source="github")]), "silver", "github", "unified_id")
    written = refresh.refresh_gold(store, AT)
    same_gold(store, spark)
    after = files()
    assert sorted(after) == ["day=2024-01-10", "day=2024-01-13", "day=2024-01-14"] and written["source_activity"] == 4
    # Only an enrichment changes: one day is made again, the others keep their files.
    store.append(spark.createDataFrame([("f", "negative", ["y"], [], None, AT + timedelta(1))], ENRICHED), "silver", "enriched")
    refresh.refresh_gold(store, AT)
    same_gold(store, spark)
    assert {d for d in after if files()[d] == after[d]} == {"day=2024-01-10", "day=2024-01-13"}
    assert refresh.refresh_gold(store, AT)["trending_topics"] == 0  # nothing new
    # Parts that were folded meanwhile, a feed that comes later, and a version that is gone.
    store.compact("silver", "hn")
    store.upsert(items(spark, [item("n", day(9), 0, source="newsapi")]), "silver", "news", "unified_id")
    refresh.refresh_gold(store, AT)
    same_gold(store, spark)
    store.upsert(items(spark, [item("c", day(8))]), "silver", "hn", "unified_id")
    for file in glob(f"{store.path('silver', 'hn')}/_versions/pin-*"):
        os.unlink(file)
    for _ in range(3):
        store.compact("silver", "hn")
    refresh.refresh_gold(store, AT)
    same_gold(store, spark)


def test_an_upsert_during_the_job_changes_none_of_its_tables(spark, store, monkeypatch):
    store.upsert(items(spark, [item("a", AT), item("b", AT)]), "silver", "hn", "unified_id")
    real = refresh.combined_where

    def meanwhile(s, versions, condition):
        store.upsert(items(spark, [item(f"x{time.time()}", AT)]), "silver", "hn", "unified_id")
        store.compact("silver", "hn")
        store.compact("silver", "hn")
        return real(s, versions, condition)

    monkeypatch.setattr(refresh, "combined_where", meanwhile)
    refresh.refresh_gold(store, AT)
    counts = lambda: {r.source: r.item_count for r in store.read("gold", "source_activity").collect()}
    assert counts() == {"hackernews": 2} and store.read("gold", "top_content").count() == 2
    assert store.made_from("gold", "source_activity") == {"silver/hn": 1} == store.made_from("gold", "top_content")
    monkeypatch.undo()
    refresh.refresh_gold(store, AT)
    assert counts() == {"hackernews": 4} and store.read("gold", "top_content").count() == 4
    same_gold(store, spark)


def test_refresh_needs_silver_and_days(spark, store):
    with pytest.raises(FileNotFoundError):
        refresh.refresh_gold(store, AT)
    store.overwrite(frame(spark, [("a", 1, 1)]), "gold", "plain")
    with pytest.raises(ValueError, match="by days"):
        store.replace_days(frame(spark, [("a", 1, 1)]).withColumn("d", F.lit(date(2024, 1, 1))), "gold", "plain", "d", [date(2024, 1, 1)])
    empty = frame(spark, []).withColumn("d", F.lit(date(2024, 1, 1)))
    assert store.replace_days(empty, "gold", "none", "d") == 0 and store.read("gold", "none").collect() == []


def test_layer_digests_see_content(spark):
    rows = [("a", 1, 0.5, [None, "x"], AT), (None, None, None, None, None)]
    kinds = "s string, n int, r double, l array<string>, t timestamp"
    digest = lambda data: metrics.layer_digests({"t": spark.createDataFrame(data, kinds)}).first().digest
    assert digest(rows) == digest(rows[::-1]) != digest(rows + rows[:1])
    assert len({digest([rows[0][:k] + (None,) + rows[0][k + 1 :]]) for k in range(5)} | {digest(rows[:1])}) == 6
    assert digest([]) == "0"


def test_every_row_of_two_versions_reads_a_shared_part_once(spark, folder):
    store = TableStore(spark, folder, "parquet")
    store.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int"), "silver", "hn", "id")
    store.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "id string, n int"), "silver", "hn", "id")
    rows = sorted((r.id, r.n) for r in store.every_row_of("silver", "hn", {1, 2}).collect())
    assert rows == [("a", 1), ("b", 1), ("b", 2), ("c", 2)]
    assert store.every_row_of("silver", "hn", {1}).count() == 2


# ---- first seen with slices -----------------------------------------------------------------

EVENTS = "user string, slice long, at timestamp, id long"


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    slices.use_rocksdb(spark)
    yield
    spark.conf.set(key, before)


def send(spark, folder, rows):
    """One file for each list of rows, each handled in a run of its own; all rows sent so far."""
    kinds = spark.createDataFrame([], EVENTS).schema
    for part in rows:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(kinds).parquet(f"{folder}/in")
        best = slices.first_seen_by_priority(stream, "user", F.col("slice"), "at", "1 hour", "1 day", "10 minutes", "id")
        start_append(best, f"{folder}/out", f"{folder}/cp", every=None).awaitTermination()
    return sorted((r.user, r.id) for r in spark.read.parquet(f"{folder}/out").collect())


def t(minutes):
    return AT + timedelta(minutes=minutes)


def test_the_better_slice_wins_though_it_comes_later(spark, folder, rocksdb):
    batches = [
        [("a", 3, t(0), 1), ("b", 2, t(1), 2), (None, 1, t(0), 3), ("c", None, t(2), 4)],
        [("a", 1, t(20), 5), ("b", 2, t(1), 6), ("c", 9, t(30), 7)],
        [("a", 2, t(40), 8), ("a", 0, t(61), 9)],  # the last one is past the hour
        [("z", 1, t(100), 10)],
    ]
    assert send(spark, folder, batches) == [("a", 5), ("b", 2), ("c", 7)]  # z still waits
    # Batch rule over the same rows: the best slice, then the earliest.
    later = [[("a", 0, t(600), 11), ("z", 5, t(601), 12)]]  # a is remembered; z's hour is over
    assert send(spark, folder, later) == [("a", 5), ("b", 2), ("c", 7), ("z", 10)]
    again = [[("a", 7, t(2000), 13)], [("q", 1, t(2200), 14)]]  # a is forgotten, and seen for the first time
    assert send(spark, folder, again) == [("a", 5), ("a", 13), ("b", 2), ("c", 7), ("z", 10)]


def test_a_key_waits_for_one_timer():
    """Thirty periods of a key that end before the watermark are settled by one timer."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

    class Kept:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers = []

        def getValueState(self, name, kind):
            return Kept()

        def registerTimer(self, at):
            self.timers.append(at)

    second = 1_000_000
    one = slices.HeldKeys(10 * second, 50 * second)
    one.init(handle := Handle())
    rows = [pd.DataFrame({"at": [k * 100 * second], "best": [str(k)], "body": [f"row {k}"]}) for k in range(30)]
    assert list(one.handleInputRows(("a",), iter(rows), TimerValues())) == []
    assert handle.timers == [10_000]
    sent = list(one.handleExpiredTimer(("a",), TimerValues(-1, 2_905_000), ExpiredTimerInfo(10_000)))
    assert [part["body"].tolist() for part in sent] == [[f"row {k}" for k in range(29)]]
    assert handle.timers == [10_000, 2_910_000]
    sent = list(one.handleExpiredTimer(("a",), TimerValues(-1, 2_911_000), ExpiredTimerInfo(2_910_000)))
    assert [part["body"].tolist() for part in sent] == [["row 29"]]
    assert list(one.handleExpiredTimer(("a",), TimerValues(-1, 3_000_000), ExpiredTimerInfo(2_960_000))) == []
    assert one.open.get() is None and handle.timers == [10_000, 2_910_000, 2_960_000]


def test_slices_do_not_depend_on_the_cut_into_triggers(spark, folder, rocksdb):
    rows = sorted(((f"u{(i * 7) % 5}", (i * 11) % 4, t((i * 37) % 4000), i) for i in range(60)), key=lambda r: r[2])
    end = [("end", 0, t(9000), 99)]
    one = send(spark, f"{folder}/one", [rows + end])
    some = send(spark, f"{folder}/some", [rows[:20], rows[20:41], rows[41:], end])
    assert one == some and len(one) > 5


# ---- metrics --------------------------------------------------------------------------------


def test_metrics_of_running_streams(spark, folder):
    heard = watch.listen(spark)
    bodies = {
        "hn": [{"id": 1, "title": "a"}, {"id": 2}, b"{broken", None, b"", b"[1]", b"null", b'"x"', b"{}", {"title": "t", "score": "many"}],
        "github": [{"repo_id": 1}, {"repo_name": "x"}],
    }
    started = {}
    for feed, body in bodies.items():
        messages(spark, body).repartition(2).write.parquet(f"{folder}/in/{feed}")
        started[feed] = file_stream(spark, f"{folder}/in/{feed}", max_files_per_trigger=1)
    running = start_feeds(started, f"{folder}/bronze", f"{folder}/cp", every=None, watch=True)
    finish_feeds(running)
    for query in running.values():
        heard.wait_for(query)
    spark.streams.removeListener(heard)
    got = {r.feed: (r["read"], r.malformed, r.incomplete, r.late, r.kept) for r in heard.table(spark).collect()}
    assert got == {"github": (2, 0, 1, 0, 1), "hn": (10, 6, 2, 0, 2)}
    assert {f: spark.read.parquet(f"{folder}/bronze/{f}").count() for f in bodies} == {f: c[4] for f, c in got.items()}


def test_watched_messages_are_parsed_alike(spark):
    rows = messages(spark, [{"id": 1, "title": "a"}, {"id": 2}, b"{x"])
    assert content(parse_messages(rows, FEEDS["hn"], AT, watch=True)) == content(parse_messages(rows, FEEDS["hn"], AT))
    assert json.loads('{"a": 1}') and silver and gold and testdata
