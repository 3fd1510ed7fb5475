from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.plans import gold, jobs
from trendloom.schemas import SILVER_SCHEMA
from trendloom.sources.tables import TableStore

AS_OF = datetime(2024, 1, 16)
TEN = datetime(2024, 1, 15, 10)
FULL = T.StructType(SILVER_SCHEMA.fields + [
    T.StructField("sentiment", T.StringType()),
    T.StructField("ai_topics", T.ArrayType(T.StringType())),
    T.StructField("ai_entities", T.ArrayType(T.StringType())),
])


def item(uid, source, title="t", popularity=10, tags=(), language=None, at=TEN, sentiment="positive"):
    return dict(unified_id=uid, source=source, title=title, author="u", popularity_score=popularity,
                tags=None if tags is None else list(tags), language=language, published_at=at, ingested_at=TEN,
                silver_processed_at=TEN, pipeline_version="1.0.0", sentiment=sentiment)


def combined(spark, *items):
    return spark.createDataFrame([tuple(i.get(n) for n in FULL.names) for i in items], FULL)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# ---- trending ---------------------------------------------------------------------------


def test_trend_score(spark):
    rows = by(gold.trending_topics(combined(
        spark,
        item("1", "hackernews", "Borrow checker tour", 100, ["rust", "systems"]),
        item("2", "newsapi", "Ownership pitfalls", 0, ["rust", "memory"], sentiment="negative"),
        item("3", "github", "No label", 20, ["rust"], sentiment=None),
        item("4", "github", "Neutral", 40, ["rust"], sentiment="neutral"),
    ), AS_OF), "tag")
    rust = rows["rust"]
    assert set(rows) == {"rust", "systems", "memory"}
    assert (rust.mention_count, rust.avg_popularity, rust.source_diversity) == (4, 40.0, 3)
    assert (rust.positive_count, rust.negative_count, rust.neutral_count) == (1, 1, 1)
    assert rust.avg_sentiment_weight == pytest.approx(1.0)
    assert rust.trend_score == pytest.approx((4 + 20 + 30) * 1.0)
    assert rows["systems"].trend_score == pytest.approx((1 + 50 + 10) * 1.2)
    assert rows["memory"].trend_score == pytest.approx((1 + 0 + 10) * 0.8)
    assert {t: r.rank_in_hour for t, r in rows.items()} == {"systems": 1, "rust": 2, "memory": 3}
    assert rust.sample_titles == ["Borrow checker tour", "Neutral", "No label"]


def test_generic_null_and_short_tags_are_left_out(spark):
    got = gold.trending_topics(combined(
        spark,
        item("1", "hackernews", tags=["hackernews", "story", "newsapi", "github", "top_headlines", "c", None, "top"]),
        item("2", "hackernews", tags=None),
        item("3", "hackernews", tags=["dateless"], at=None),
    ))
    assert [r.tag for r in got.collect()] == ["top"]


def test_two_sources_outrank_one(spark):
    rows = by(gold.trending_topics(combined(
        spark,
        item("1", "hackernews", popularity=50, tags=["python"]),
        item("2", "github", popularity=50, tags=["python"]),
        item("3", "hackernews", popularity=50, tags=["rust"]),
    )), "tag")
    assert rows["python"].rank_in_hour == 1 and rows["rust"].rank_in_hour == 2


def test_null_popularity_ranks_last_and_ties_share_a_rank(spark):
    rows = by(gold.trending_topics(combined(
        spark,
        item("1", "github", popularity=None, tags=["blank"]),
        item("2", "github", popularity=4, tags=["one", "two"]),
    )), "tag")
    assert rows["blank"].trend_score is None and rows["blank"].rank_in_hour == 3
    assert rows["one"].rank_in_hour == rows["two"].rank_in_hour == 1


def test_topics_of_the_model_can_be_used(spark):
    rows = combined(spark, item("1", "hackernews", tags=["x1"])).withColumn("ai_topics", F.array(F.lit("llm")))
    assert [r.tag for r in gold.trending_topics(rows, topic_col="ai_topics").collect()] == ["llm"]


def test_group_with_untitled_items_has_no_samples(spark):
    row = gold.trending_topics(combined(spark, item("1", "github", None, tags=["x1"]))).first()
    assert row.sample_titles == []


# ---- languages --------------------------------------------------------------------------


def test_language_and_tag_both_count(spark):
    rows = by(gold.language_momentum(combined(
        spark,
        item("1", "github", popularity=1000, tags=["Rust", "go"], language="rust"),
        item("2", "github", popularity=500, tags=None, language="Python", sentiment="negative"),
        item("3", "newsapi", popularity=0, tags=["python"], sentiment="negative"),
        item("4", "github", tags=["swift"], language=" ", at=None),
    )), "language")
    assert set(rows) == {"rust", "go", "Python", "python"}
    rust = rows["rust"]
    assert (rust.mention_count, rust.total_stars, rust.source_diversity) == (2, 2000, 1)
    assert rust.momentum_score == pytest.approx((2000 + 10) * 1.3) and rust.dominant_sentiment == "positive"
    assert rows["Python"].momentum_score == pytest.approx((500 + 5) * 0.7)
    assert rows["python"].dominant_sentiment == "negative" and rows["python"].rank_by_day == 4


def test_dateless_language_is_kept_and_case_can_be_joined(spark):
    items = combined(
        spark,
        item("1", "github", language="Go", at=None, tags=["go"]),
        item("2", "github", language="go", at=None),
    )
    rows = by(gold.language_momentum(items), "day_window", "language")
    assert set(rows) == {(None, "Go"), (None, "go")}
    joined = gold.language_momentum(items, normalise_case=True).collect()
    assert [(r.language, r.mention_count) for r in joined] == [("go", 2)]


# ---- activity ---------------------------------------------------------------------------


def test_activity(spark):
    rows = by(gold.source_activity(combined(
        spark,
        item("1", "hackernews", popularity=10), item("2", "hackernews", popularity=20, sentiment="negative"),
        item("3", "hackernews", popularity=60, sentiment=None), item("4", "newsapi", popularity=0, sentiment="neutral"),
        item("5", "newsapi", at=None), item("6", "github", popularity=None),
    )), "source")
    hn = rows["hackernews"]
    assert (hn.item_count, hn.avg_popularity, hn.peak_popularity, hn.total_popularity) == (3, 30.0, 60, 90)
    assert (hn.positive_items, hn.negative_items, hn.neutral_items, hn.unenriched_items) == (1, 1, 0, 1)
    assert (hn.positive_rate_pct, hn.negative_rate_pct, hn.avg_sentiment_score) == (33.3, 33.3, 0.0)
    assert hn.activity_score == pytest.approx(90.0)
    assert rows["newsapi"].item_count == 1 and rows["newsapi"].neutral_items == 1
    assert rows["github"].avg_popularity is None and rows["github"].activity_score is None


# ---- content ----------------------------------------------------------------------------


def test_scores_ranks_and_period(spark):
    rows = by(gold.top_content(combined(
        spark,
        item("1", "hackernews", "a", 100), item("2", "github", "b", 1000, sentiment=None),
        item("3", "newsapi", "c", 0, sentiment="negative"), item("4", "github", "d", None),
        item("5", "hackernews", "old", 999, at=datetime(2024, 1, 8, 23)), item("6", "hackernews", "edge", 1, at=datetime(2024, 1, 9)),
    ), AS_OF), "title")
    assert set(rows) == {"a", "b", "c", "d", "edge"}
    assert rows["a"].final_score == pytest.approx(110.0) and rows["b"].final_score == 100.0
    assert rows["c"].final_score == pytest.approx(1705312800 / 1e9 * 0.95)
    assert {t: r.global_rank for t, r in rows.items()} == {"a": 1, "b": 2, "c": 3, "edge": 4, "d": 5}
    assert {t: r.source_rank for t, r in rows.items()} == {"a": 1, "b": 1, "c": 1, "edge": 2, "d": 2}


def test_fifty_ranks_per_source_with_ties(spark):
    items = [item(f"h{i}", "hackernews", f"t{i}", i) for i in range(60)]
    items += [item(f"g{i}", "github", f"g{i}", 50) for i in range(70)]
    got = gold.top_content(combined(spark, *items), AS_OF).collect()
    assert sum(r.source == "hackernews" for r in got) == 50
    assert sum(r.source == "github" for r in got) == 70
    # 5.5 points each: behind stories 6 to 59, level with story 5.
    assert {r.global_rank for r in got if r.source == "github"} == {55}


def test_default_period_is_today(spark):
    fresh = combined(spark, item("1", "github")).withColumn("published_at", F.current_timestamp())
    assert gold.top_content(fresh).count() == 1
    assert gold.top_content(combined(spark, item("1", "github"))).count() == 0


def test_wide_rows_are_not_shuffled(spark):
    df = gold.top_content(combined(spark, item("1", "github")), AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # the leaders are stored, and Spark has found them small
    for step in ("hashpartitioning", "SinglePartition", "Window", "Aggregate"):
        assert step not in plan


# ---- combining --------------------------------------------------------------------------


def test_combine_keeps_newest_and_does_not_fan_out(spark):
    later = dict(item("1", "github", "new"), silver_processed_at=datetime(2024, 1, 17))
    schema = SILVER_SCHEMA
    silver = spark.createDataFrame(
        [tuple(i.get(n) for n in schema.names) for i in (item("1", "github", "old"), later, item("2", "newsapi"))], schema
    )
    enriched = spark.createDataFrame(
        [("1", "negative", datetime(2024, 1, 1)), ("1", "positive", datetime(2024, 1, 2)), (None, "neutral", None)],
        "unified_id string, sentiment string, enriched_at timestamp",
    )
    rows = by(gold.combine_silver([silver, silver.limit(0)], enriched), "unified_id")
    assert rows["1"].title == "new" and rows["1"].sentiment == "positive"
    assert rows["2"].sentiment is None and len(rows) == 2


def test_keyed_tables_are_combined_without_sorting_them_again(spark, folder):
    store = TableStore(spark, folder, "parquet")
    rows = {feed: spark.createDataFrame([tuple(item(feed, source).get(n) for n in SILVER_SCHEMA.names)], SILVER_SCHEMA)
            for feed, source in (("hn", "hackernews"), ("github", "github"))}
    for feed, df in rows.items():
        store.upsert(df, "silver", feed, "unified_id")
    got = jobs.load_combined(store)
    assert sorted(map(str, got.collect())) == sorted(map(str, gold.combine_silver(list(rows.values())).collect()))
    plan = got.select("source", "published_at")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "tags" not in plan
    store.overwrite(rows["hn"].unionAll(rows["hn"]), "silver", "hn")  # not kept by id: cut to one row each
    assert jobs.load_combined(store).count() == 2


def test_equal_stamps_give_the_same_row_in_any_order(spark):
    rows = [("1", "negative", ["a"], ["x"]), ("1", "negative", ["b"], ["x"]), ("1", "negative", ["b"], ["y"]), ("1", "neutral", None, None)]
    silver = spark.createDataFrame([tuple(item("1", "github").get(n) for n in SILVER_SCHEMA.names)], SILVER_SCHEMA)
    seen = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        enriched = spark.createDataFrame(order, "unified_id string, sentiment string, ai_topics array<string>, ai_entities array<string>").repartition(3)
        row = gold.attach_enrichment(silver, enriched).first()
        seen.add((row.sentiment, str(row.ai_topics), str(row.ai_entities)))
    assert len(seen) == 1


def test_without_enrichment_the_columns_are_null(spark):
    silver = spark.createDataFrame([], SILVER_SCHEMA)
    rows = gold.combine_silver([silver], None)
    assert dict(rows.dtypes)["ai_topics"] == "array<string>"
    assert gold.trending_topics(rows).count() == 0


def test_gold_job_writes_only_what_builders_read(spark, folder):
    store = TableStore(spark, folder, "parquet")
    given = [{**item(str(n), "github"), "url": f"u{n}", "author": f"a{n}", "description": f"d{n}"} for n in range(3)]
    rows = spark.createDataFrame([tuple(i.get(n) for n in SILVER_SCHEMA.names) for i in given], SILVER_SCHEMA)
    store.upsert(rows, "silver", "github", "unified_id")
    jobs.run_gold(store, AS_OF)
    written = set(store.read("work", "combined").columns)
    assert not written & {*gold.LOOKED_UP, *gold.UNREAD} and {"unified_id", "title", "tags", "ai_topics"} <= written
    shown = lambda df: sorted(map(str, df.drop("gold_computed_at").collect()))
    for name, build in jobs.BUILDERS.items():
        assert shown(store.read("gold", name)) == shown(build(jobs.load_combined(store), AS_OF)), name
    assert {(r.url, r.author, r.description) for r in store.read("gold", "top_content").collect()} == {(f"u{n}", f"a{n}", f"d{n}") for n in range(3)}
