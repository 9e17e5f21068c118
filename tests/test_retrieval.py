from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.operators import answers, rerank
from textlake.operators.embedding import embed_text, embed_tfidf, fit_tfidf


def test_word_overlap(spark):
    df = spark.createDataFrame(
        [("A b b c", "b  C d"), ("x", "x"), ("", " "), ("a", "")], "a string, b string"
    )
    score = rerank.shared_words(rerank.words(F.col("a")), rerank.words(F.col("b")))
    assert [r["s"] for r in df.select(score.alias("s")).collect()] == [0.5, 1.0, 0.0, 0.0]


@pytest.fixture
def asked(spark):
    return spark.createDataFrame([(1, "red fish"), (2, "blue")], "query_id int, query string")


@pytest.fixture
def passages(spark):
    return spark.createDataFrame(
        [(1, "blue fish"), (2, "red fish"), (3, "red fish swims"), (4, "one"), (5, "two")],
        "doc_id int, text string",
    )


def test_rerank(spark, asked, passages):
    hits = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 3), (1, 4), (2, 4), (2, 5)], "query_id int, doc_id int"
    )
    got = rerank.rerank(asked, hits, passages, 3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["doc_id"], r["passage"]) for r in got] == [
        (1, 2, "red fish"),
        (1, 3, "red fish swims"),
        (1, 1, "blue fish"),
        (2, 4, "one"),
        (2, 5, "two"),
    ]


def test_rerank_without_hits(spark, asked, passages):
    hits = spark.createDataFrame([], "query_id int, doc_id int")
    assert rerank.rerank(asked, hits, passages).count() == 0


def test_rerank_with_a_model(spark, asked, passages):
    def load():
        return lambda queries, texts: np.array([len(t) for t in texts], dtype=float)

    hits = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "query_id int, doc_id int")
    got = rerank.rerank(asked, hits, passages, 2, rerank.model_scorer(load)).orderBy("rank")
    assert [(r["doc_id"], r["score"]) for r in got.collect()] == [(3, 14.0), (1, 9.0)]


def test_embed_text(spark):
    df = spark.createDataFrame(
        [(1, "a b a"), (2, "A  B a"), (3, None), (4, "c")], "id int, text string"
    )
    rows = {r["id"]: r["embedding"] for r in embed_text(df, batch_size=2).collect()}
    assert rows.pop(3) is None  # a text without words has no direction
    got = {i: np.array(v) for i, v in rows.items()}
    assert all(len(v) == 384 for v in got.values())
    assert np.allclose([np.linalg.norm(got[i]) for i in (1, 2, 4)], 1)
    assert np.array_equal(got[1], got[2])


def test_embed_text_with_a_model_loaded_once_per_task(spark):
    def load():
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return np.array([[3.0, 4.0 * len(calls) / len(calls)]] * len(texts))

        return encode

    df = spark.range(0, 50, 1, 2).select(F.col("id").cast("string").alias("text"))
    got = embed_text(df, load, batch_size=8).collect()
    assert len(got) == 50
    assert all(np.allclose(r["embedding"], [0.6, 0.8]) for r in got)


def test_embed_tfidf(spark):
    df = spark.createDataFrame(
        [(1, "red fish"), (2, "red fish"), (3, "blue bird")], "id int, text string"
    )
    model = fit_tfidf(df)
    got = {r["id"]: np.array(r["embedding"]) for r in embed_tfidf(df, model).collect()}
    assert np.allclose([np.linalg.norm(v) for v in got.values()], 1)
    assert np.array_equal(got[1], got[2])
    assert not np.array_equal(got[1], got[3])


def test_tfidf_weighs_rare_words_more(spark):
    # m documents, a word in n of them: weight log((m + 1) / (n + 1)) per occurrence.
    df = spark.createDataFrame(
        [(1, "common rare rare"), (2, "common"), (3, "common other")], "id int, text string"
    )
    got = {r["id"]: np.array(r["embedding"]) for r in embed_tfidf(df, fit_tfidf(df)).collect()}
    assert not got[2].any()
    assert sorted(got[1][got[1] > 0]) == [1.0]
    df = spark.createDataFrame(
        [(1, "a b b"), (2, "a c"), (3, "d")], "id int, text string"
    )
    got = {r["id"]: np.array(r["embedding"]) for r in embed_tfidf(df, fit_tfidf(df)).collect()}
    a, b = np.log(4 / 3), 2 * np.log(4 / 2)
    assert np.allclose(sorted(got[1][got[1] > 0]), sorted(np.array([a, b]) / np.hypot(a, b)))


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(
        [
            ("d1", "T1\n S1 ", ("src", "l1", "p1", "neutral")),
            ("d2", "T2", ("src", "l2", "", "positive")),
        ],
        "doc_id string, page_content string, metadata struct<source: string, link: string, "
        "published: string, sentiment: string>",
    )


@pytest.fixture
def queries(spark):
    return spark.createDataFrame(
        [(1, "what?", [1.0, 0.0]), (2, "who?", [-1.0, 0.0])],
        "query_id int, query string, embedding array<float>",
    )


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(
        [("d1", [0.6, 0.8]), ("d2", [1.0, 0.0])], "doc_id string, embedding array<float>"
    )


CONTEXT = (
    "[1] T2\n\nSource: src | Link: l2 | Published:  | Sentiment: positive\n\n"
    "[2] T1\nS1\nSource: src | Link: l1 | Published: p1 | Sentiment: neutral"
)


def test_answer_rows(queries, corpus, documents):
    rows = answers.answer_queries(queries, corpus, documents).orderBy("query_id").collect()
    found, nothing = rows
    assert found["status"] == "model_unavailable"
    assert found["answer"] == fixed.ANSWER_MODEL_UNAVAILABLE
    assert found["context"] == CONTEXT
    assert [s.asDict() for s in found["sources"]] == [
        {"title": "T2", "link": "l2", "source": "src", "published": "", "sentiment": "positive",
         "score": 0.0},
        {"title": "T1", "link": "l1", "source": "src", "published": "p1", "sentiment": "neutral",
         "score": 0.8},
    ]
    assert found["prompt"].endswith(
        "News Context:\n" + CONTEXT + "\n\nQuestion: what?\nAnswer:"
    )
    assert (nothing["status"], nothing["sources"], nothing["prompt"]) == ("nothing_found", [], None)
    assert nothing["answer"] == fixed.ANSWER_NOTHING_FOUND


def test_answer_rows_without_model(queries, corpus, documents):
    rows = answers.answer_queries(queries, corpus, documents, use_model=False).collect()
    assert {r["status"] for r in rows} == {"retrieval_only", "nothing_found"}


def test_answer_rows_with_answers_of_a_model(spark, queries, corpus, documents):
    given = spark.createDataFrame([(1, "It is T2."), (2, "unused")], "query_id int, answer string")
    rows = answers.answer_queries(queries, corpus, documents, model_answers=given)
    assert [(r["status"], r["answer"]) for r in rows.orderBy("query_id").collect()] == [
        ("answered", "It is T2."),
        ("nothing_found", fixed.ANSWER_NOTHING_FOUND),
    ]


@pytest.mark.parametrize("top_k", [0, 11])
def test_top_k_is_checked(queries, corpus, documents, top_k):
    with pytest.raises(ValueError):
        answers.answer_queries(queries, corpus, documents, top_k)
