"""Scoring query and passage together, and keeping the best."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions.fixed_values import CANDIDATE_K, RERANK_K
from textlake.operators.dedupe import top_per_group
from textlake.operators.merge import few
from textlake.operators.nearest import nearest

@dataclass(frozen=True)
class Scorer:
    """How well a passage fits a query; higher is better.

    ``prepare`` is applied to a query, and to a passage that was found for one;
    ``score`` to the two things it gives.
    """

    score: Callable[[Column, Column], Column]
    prepare: Callable[[Column], Column] = lambda text: text


def words(text: Column) -> Column:
    """The different lower-cased words of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"\s+")), "")


def shared_words(a: Column, b: Column) -> Column:
    """Words in both arrays over words in either: 1 for the same set of words."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.coalesce(F.try_divide(shared, every), F.lit(0.0))


WORD_OVERLAP = Scorer(shared_words, words)


def model_scorer(
    load_model: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]],
    batch_size: int = 64,
) -> Scorer:
    """A scorer from a model, loaded once in each Python worker.

    ``load_model`` returns a function from an array of queries and one of
    passages to an array of scores.
    """

    def make_predict():
        model = load_model()
        return lambda queries, passages: np.asarray(model(queries, passages), dtype=np.float64)

    return Scorer(
        predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size)
    )


def rerank(
    queries: DataFrame,
    hits: DataFrame,
    passages: DataFrame,
    k: int = RERANK_K,
    scorer: Scorer = WORD_OVERLAP,
) -> DataFrame:
    """The ``k`` best hits of each query by score, ties by ``doc_id``.

    ``queries`` has ``query_id, query``, ``passages`` ``doc_id, text``. The
    result is ``query_id, doc_id, passage, score, rank``; no hit gives no row.
    Passages are prepared after the join: only those found, not all there are.
    The hits go to the passages when they are measured to be few, so the texts
    are not shuffled. A hit whose passage is missing can't be scored; see
    ``answers.with_documents`` for hits that must not be lost.
    """
    asked = queries.select("query_id", scorer.prepare(F.col("query")).alias("_query"))
    scored = (
        passages.select("doc_id", F.col("text").alias("passage"))
        .join(few(hits.select("query_id", "doc_id")), "doc_id")
        .join(asked, "query_id")
        .select(
            "query_id",
            "doc_id",
            "passage",
            scorer.score(F.col("_query"), scorer.prepare(F.col("passage"))).alias("score"),
        )
    )
    return top_per_group(scored, ["query_id"], [F.desc("score"), "doc_id"], k)


def retrieve_and_rerank(
    queries: DataFrame,
    corpus: DataFrame,
    passages: DataFrame,
    candidate_k: int = CANDIDATE_K,
    final_k: int = RERANK_K,
    scorer: Scorer = WORD_OVERLAP,
    **search,
) -> DataFrame:
    """The nearest ``candidate_k`` passages of each query, reranked to ``final_k``."""
    hits = nearest(queries, corpus, candidate_k, **search)
    return rerank(queries, hits, passages, final_k, scorer)
