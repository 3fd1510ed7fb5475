from datetime import datetime

import pytest

from trendloom.plans import retrieval

DAY = datetime(2024, 1, 15)
CONTENT = (
    "global_rank int, source string, title string, url string, author string, description string, "
    "popularity_score int, language string, tags array<string>, published_at timestamp"
)
TRENDING = (
    "hour_window timestamp, tag string, mention_count bigint, source_diversity bigint, trend_score double, "
    "rank_in_hour int, sample_titles array<string>"
)
MOMENTUM = (
    "day_window timestamp, language string, momentum_score double, total_stars bigint, mention_count bigint, "
    "source_diversity bigint, rank_by_day int"
)


def test_content_documents(spark):
    rows = [
        (1, "github", "o/r", "u", "me", "", 100, None, ["github", "x"], DAY.replace(hour=10)),
        (1, "hackernews", None, None, None, "text", None, "Go", None, None),
        (101, "github", "late", "u", "me", "d", 1, None, [], DAY),
    ]
    docs = {r.id: r for r in retrieval.content_documents(spark.createDataFrame(rows, CONTENT)).collect()}
    assert set(docs) == {"content_0_1", "content_1_1"}
    assert docs["content_0_1"].text == (
        "Source: github. Title: o/r. Description: N/A. Author: me. Popularity score: 100. Language: N/A. "
        "Tags: github, x. Published: 2024-01-15 10:00:00."
    )
    assert docs["content_1_1"].text == (
        "Source: hackernews. Title: None. Description: text. Author: unknown. Popularity score: None. "
        "Language: Go. Tags: . Published: None."
    )
    assert docs["content_0_1"].metadata == {
        "type": "top_content", "source": "github", "title": "o/r", "score": "100", "rank": "1", "language": "",
    }


def test_topic_documents(spark):
    rows = [
        (DAY, "ai", 3, 2, 12.25, 1, ["a", "b", "c"]), (DAY.replace(hour=1), "go", 1, 1, 13.2, 1, []),
        (DAY, "late", 1, 1, 1.0, 21, []),
    ]
    docs = {r.id: r for r in retrieval.topic_documents(spark.createDataFrame(rows, TRENDING)).collect()}
    assert set(docs) == {"trend_0_ai", "trend_1_go"}
    assert docs["trend_0_ai"].text == (
        "Trending topic: ai. Time window: 2024-01-15 00:00:00. Mentioned 3 times. Across 2 different sources. "
        f"Trend score: {12.25:.1f}. Rank in this hour: 1. Example titles: a; b."
    )
    assert docs["trend_1_go"].metadata["score"] == "13.2" and docs["trend_0_ai"].metadata["score"] == "12.25"


def test_language_documents(spark):
    rows = [(DAY, "rust", 130.5, 90, 2, 1, 1), (None, "go", 10.0, 5, 1, 1, 1), (DAY, "late", 1.0, 1, 1, 1, 11)]
    docs = {r.id: r for r in retrieval.language_documents(spark.createDataFrame(rows, MOMENTUM)).collect()}
    assert set(docs) == {"lang_0_go_None", "lang_1_rust_2024-01-15 00:00:00"}
    rust = docs["lang_1_rust_2024-01-15 00:00:00"]
    assert rust.text == (
        "Programming language: rust. Day: 2024-01-15 00:00:00. Momentum score: 130. Total stars: 90. "
        "Mentioned 2 times. Across 1 sources. Rank today: 1."
    )
    assert rust.metadata["momentum"] == str(round(130.5, 0))


def test_embedding_has_unit_length_and_follows_words(spark):
    docs = spark.createDataFrame([("a", "Rust rust go"), ("b", "go, rust RUST"), ("c", None)], "id string, text string")
    got = {r.id: r.embedding for r in retrieval.embed_documents(docs).collect()}
    assert got["a"] == got["b"] and len(got["a"]) == retrieval.EMBEDDING_SIZE
    assert sum(x * x for x in got["a"]) == pytest.approx(1.0, abs=1e-6)
    assert set(got["c"]) == {0.0}


def test_words_of_any_script_stay_whole(spark):
    texts = ["über schöne Grüße", "ber sch ne gr e", "ÜBER; schöne-GRÜßE", "привет мир", "мир", "你好 世界"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.embedding for r in retrieval.embed_documents(docs).collect()}
    assert got[0] == got[2] != got[1]
    assert all(any(v) for v in got.values()) and got[3] != got[4]


@pytest.mark.parametrize("block", [4096, 2])
def test_each_question_is_embedded_once(spark, folder, block):
    """Also with several blocks, and with a question id that occurs twice."""
    from trendloom.operators.vectors import cosine_topk

    log = f"{folder}/calls"

    def counting():
        def encode(texts):
            with open(log, "a") as file:
                file.writelines(f"{t}\n" for t in texts)
            return letters()(texts)
        return encode

    questions = spark.createDataFrame([("q1", "a"), ("q2", "b"), ("q3", "c"), ("q4", "d"), ("q1", "a")], "question_id string, question string")
    docs = retrieval.embed_documents(spark.createDataFrame([("d1", "ab"), ("d2", "cd")], "id string, text string"), letters)
    hits = cosine_topk(retrieval.embed_documents(questions, counting, "question"), docs, 1, block=block).collect()
    assert sorted((h.question_id, h.id) for h in hits) == [("q1", "d1"), ("q2", "d1"), ("q3", "d2"), ("q4", "d2")]
    assert sorted(open(log).read().split()) == ["a", "a", "b", "c", "d"]


def letters():
    return lambda texts: [[float(t.lower().count(c)) for c in "abcde"] for t in texts]


def test_injected_embedder_gets_batches(spark):
    def strict():
        def encode(texts):
            assert len(texts) <= 3
            return letters()(texts)
        return encode

    docs = spark.createDataFrame([(i, "a" * i) for i in range(10)], "id int, text string")
    got = {r.id: r.embedding[0] for r in retrieval.embed_documents(docs, strict, batch_size=3).collect()}
    assert got == {i: float(i) for i in range(10)}


def test_ask_assembles_context_in_order_and_answers(spark):
    docs = spark.createDataFrame(
        [("d1", "aab", {"type": "top_content"}), ("d2", "a", {"type": "trending_topic"}), ("d3", "e", {}), ("d4", "c", {"type": "x"})],
        "id string, text string, metadata map<string,string>",
    )
    questions = spark.createDataFrame([("q1", "a"), ("q2", "e")], "question_id string, question string")
    corpus = retrieval.embed_documents(docs, letters)

    def responder():
        def answer(prompt):
            if prompt.endswith("Question: e\nAnswer:"):
                raise ValueError("no model")
            return f"{len(prompt)} characters"
        return answer

    rows = {r.question_id: r for r in retrieval.ask(questions, corpus, 2, letters, responder).collect()}
    assert rows["q1"].context == "[100.0% relevant | trending_topic]\na\n\n---\n\n[89.4% relevant | top_content]\naab"
    assert rows["q2"].context.startswith("[100.0% relevant | unknown]\ne")
    assert rows["q1"].answer == f"{len(rows['q1'].prompt)} characters" and rows["q1"].answer_error is None
    assert rows["q2"].answer is None and rows["q2"].answer_error == "no model"


def test_half_a_millionth_is_told_as_the_sql_does(spark):
    """16,384 is a sum of squares with the norm 128, so odd counts are half-way between two millionths."""
    from trendloom.registry.queries import VECTOR_TEXT

    text = " ".join(["a"] * 127 + ["b"] * 15 + ["c"] * 5 + ["d"] * 2 + ["e"])  # 16129 + 225 + 25 + 4 + 1
    vectors = retrieval.embed_documents(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    told = vectors.selectExpr(f"{VECTOR_TEXT} as t").first().t
    # 127/128, 15/128, 5/128, 1/64 and 1/128 in millionths, halves away from zero.
    assert sorted(int(p.split("=")[1]) for p in told.split()) == [7813, 15625, 39063, 117188, 992188]
