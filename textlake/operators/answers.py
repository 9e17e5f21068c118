"""Hits to contexts, citations, prompts and answer rows.

The hits of a query are few: their number is the checked ``top_k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.functions import text as tx
from textlake.operators.merge import few
from textlake.operators.nearest import nearest, relevant


def check_top_k(top_k: int) -> int:
    if not 1 <= top_k <= fixed.MAX_TOP_K:
        raise ValueError(f"top_k must be from 1 to {fixed.MAX_TOP_K}")
    return top_k


def _in_rank_order(value: Column) -> Column:
    """The values of a group as an array, by rank."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("rank"), value.alias("value"))))
    return F.transform(pairs, lambda pair: pair["value"])


def plain_context(ranked: DataFrame, text: str = "passage") -> DataFrame:
    """``query_id, context``: the texts of a query's hits, a blank line between two."""
    return ranked.groupBy("query_id").agg(
        F.array_join(_in_rank_order(F.col(text)), "\n\n").alias("context")
    )


def with_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits with ``page_content`` and ``metadata`` of their document.

    Few hits (measured) go to the documents, whose texts are then not shuffled.
    Hits without a document are not among the rows.
    """
    return documents.select("doc_id", "page_content", "metadata").join(few(hits), "doc_id")


def citation_block() -> Column:
    """One hit as numbered text with where it comes from."""
    meta = F.col("metadata")
    return F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] "),
        tx.content_title(F.col("page_content")), F.lit("\n"),
        tx.content_body(F.col("page_content")), F.lit("\nSource: "),
        meta["source"], F.lit(" | Link: "),
        meta["link"], F.lit(" | Published: "),
        meta["published"], F.lit(" | Sentiment: "),
        meta["sentiment"],
    )


def citation() -> Column:
    """One hit as an entry of ``sources``."""
    meta = F.col("metadata")
    return F.struct(
        tx.content_title(F.col("page_content")).alias("title"),
        meta["link"].alias("link"),
        meta["source"].alias("source"),
        meta["published"].alias("published"),
        meta["sentiment"].alias("sentiment"),
        F.round("distance", 4).alias("score"),
    )


def cited_context(hits: DataFrame) -> DataFrame:
    """``query_id, context, sources`` of hits that carry their documents."""
    return hits.groupBy("query_id").agg(
        F.array_join(_in_rank_order(citation_block()), "\n\n").alias("context"),
        _in_rank_order(citation()).alias("sources"),
    )


def news_prompt(context: Column, question: Column) -> Column:
    return tx.fill_template(fixed.NEWS_PROMPT, context=context, question=question)


def document_prompt(context: Column, question: Column) -> Column:
    return tx.fill_template(fixed.DOCUMENT_PROMPT, context=context, question=question)


def translation_prompt(question: Column) -> Column:
    return tx.fill_template(fixed.TRANSLATION_PROMPT, question=question)


def answer_rows(
    queries: DataFrame,
    hits: DataFrame,
    documents: DataFrame,
    use_model: bool = True,
    model_answers: DataFrame | None = None,
) -> DataFrame:
    """One row per query: ``query_id, query, status, answer, sources, context, prompt``.

    A query without hits stays, with no sources and no prompt (``nothing_found``);
    so does one of whose hits no document is there (``text_missing``). ``prompt`` is
    ready for a batch model; pass its ``query_id, answer`` as ``model_answers``
    to have them here. Until then, ``answer`` says why there is none.
    """
    found = cited_context(with_documents(hits, documents))
    hit = hits.select("query_id").distinct().withColumn("_hit", F.lit(True))
    rows = (
        queries.select("query_id", "query")
        .join(found, "query_id", "left")
        .join(hit, "query_id", "left")
    )
    empty = F.col("context").isNull()
    if model_answers is not None and use_model:
        rows = rows.join(
            model_answers.select("query_id", F.col("answer").alias("_answer")), "query_id", "left"
        )
    else:
        rows = rows.withColumn("_answer", F.lit(None).cast("string"))
    without = "model_unavailable" if use_model else "retrieval_only"
    text = fixed.ANSWER_MODEL_UNAVAILABLE if use_model else fixed.ANSWER_RETRIEVAL_ONLY
    return rows.select(
        "query_id",
        "query",
        F.when(empty & F.col("_hit"), "text_missing")
        .when(empty, "nothing_found")
        .when(F.col("_answer").isNotNull(), "answered")
        .otherwise(without)
        .alias("status"),
        F.when(empty, fixed.ANSWER_NOTHING_FOUND)
        .otherwise(F.coalesce("_answer", F.lit(text)))
        .alias("answer"),
        F.coalesce("sources", F.array().cast(found.schema["sources"].dataType)).alias("sources"),
        F.coalesce("context", F.lit("")).alias("context"),
        F.when(~empty, news_prompt(F.col("context"), F.col("query"))).alias("prompt"),
    )


def answer_queries(
    queries: DataFrame,
    corpus: DataFrame,
    documents: DataFrame,
    top_k: int = fixed.TOP_K,
    threshold: float = fixed.RELEVANCE_THRESHOLD,
    use_model: bool = True,
    model_answers: DataFrame | None = None,
    **search,
) -> DataFrame:
    """Search, drop what is not relevant, and build the answer row of each query.

    ``queries`` has ``query_id, query, embedding``, ``corpus`` ``doc_id,
    embedding``, ``documents`` ``doc_id, page_content, metadata``.
    """
    hits = relevant(nearest(queries, corpus, check_top_k(top_k), **search), threshold)
    return answer_rows(queries, hits, documents, use_model, model_answers)
