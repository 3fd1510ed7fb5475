from datetime import datetime

from pyspark.sql import functions as F

from trendloom.sources import feeds

AT = datetime(2024, 1, 31)
REPO = (
    "id bigint, full_name string, html_url string, description string, stargazers_count int, forks_count int, "
    "language string, topics array<string>, created_at string, updated_at string, owner struct<login:string,type:string>"
)
ARTICLE = (
    "title string, description string, url string, publishedAt string, author string, "
    "source struct<id:string,name:string>, query string"
)


def repo(i, language=None, stars=100, created="2024-01-30T00:00:00Z", **more):
    base = dict(id=i, full_name=f"o/{i}", html_url="u", stargazers_count=stars, language=language, created_at=created)
    return {**base, **more}


def article(url, query="top", title="T", at="2024-01-01T00:00:00Z", **more):
    return {**dict(title=title, url=url, publishedAt=at, query=query), **more}


def frame(spark, schema, *rows):
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(n) for n in empty.columns) for r in rows], empty.schema)


def test_stories_and_metadata(spark):
    items = spark.createDataFrame(
        [(1, "story", "Show", 7), (2, "job", "Job", 1), (3, "story", "", 1), (4, "story", None, 1), (5, "story", "B", 2)],
        "id int, type string, title string, score int",
    )
    seen = spark.createDataFrame([(5,)], "id int")
    members = items.selectExpr("id", "'top' as feed")
    row = feeds.hn_messages(items, members, [F.col("id")], seen, AT).collect()
    assert [r.asDict() for r in row] == [{
        "id": 1, "type": "story", "title": "Show", "score": 7, "ingested_at": "2024-01-31T00:00:00+00:00",
        "source": "hackernews", "pipeline_version": "1.0.0",
    }]


def test_feed_heads_are_cut_and_merged(spark):
    members = spark.range(200).selectExpr("id", "'top' as feed").unionByName(
        spark.range(30, 230).selectExpr("id", "'new' as feed")
    ).unionByName(spark.range(900, 910).selectExpr("id", "'best' as feed"))
    ids = sorted(r.id for r in feeds.hn_feed_ids(members, [F.col("id")]).collect())
    assert ids == list(range(80))


def test_article_fields(spark):
    flat = feeds.flatten_articles(frame(
        spark, ARTICLE,
        article("https://a/1", "ai", description="d", author="x", source=("id", "Wire")),
        article(None, None, None, None),
    ), AT).collect()
    full, minimal = sorted(flat, key=lambda r: r.url, reverse=True)
    assert (full.source_name, full.query_tag, full.author, full.source) == ("Wire", "ai", "x", "newsapi")
    assert len(full.article_id) == 32 and full.article_id != minimal.article_id
    assert (minimal.title, minimal.description, minimal.source_name, minimal.query_tag) == ("", "", "", None)


def test_removed_untitled_and_addressless_articles_are_invalid(spark):
    rows = frame(spark, ARTICLE, article("u"), article("u", title="[Removed]"), article("u", title=""),
                 article("u", title=None), article(""), article(None))
    assert feeds.valid_articles(rows).count() == 1


def test_newest_twenty_per_query_and_hundred_headlines(spark):
    rows = [article(f"u{i:03d}", q, at=f"2024-01-{i % 28 + 1:02d}") for q in ("top", "ai") for i in range(150)]
    kept = feeds.newest_articles(frame(spark, ARTICLE, *rows)).groupBy("query").count().collect()
    assert {r["query"]: r["count"] for r in kept} == {"top": 100, "ai": 20}


def test_headlines_win_over_queries(spark):
    rows = frame(spark, ARTICLE, article("u1", "machine learning"), article("u1", "top"), article("u2", "machine learning"))
    got = feeds.news_messages(rows, at=AT).collect()
    assert sorted((r.url, r.query_tag) for r in got) == [("u1", "top"), ("u2", "machine learning")]


def test_repositories(spark):
    rows = [repo(i, "Rust" if i % 2 else "Zig", stars=1000 - i) for i in range(100)]
    rows += [repo(200, stars=10), repo(201, created="2024-01-24T12:00:00Z"), repo(202, created="")]
    got = feeds.repo_messages(frame(spark, REPO, *rows), AT, at=AT).collect()
    slices = {}
    for r in got:
        slices.setdefault(r.language_filter, set()).add(r.repo_id)
    assert slices["all"] == set(range(30))
    assert slices["rust"] == {i for i in range(30, 60) if i % 2}


def test_repository_fields(spark):
    selected = frame(spark, REPO, repo(1, "Go", topics=["x"], owner=("me", "User"), forks_count=3), repo(2, stars=None))
    full, minimal = sorted(feeds.flatten_repos(selected.withColumn("language_filter", F.lit("all")), AT).collect(), key=lambda r: r.repo_id)
    assert (full.repo_name, full.owner, full.topics, full.forks, full.source) == ("o/1", "me", ["x"], 3, "github")
    assert (minimal.owner, minimal.topics, minimal.stars, minimal.language, minimal.description) == ("", [], 0, "", "")
