"""Search, reranking and answers: every vector of ``embeddings`` is a query.

A query's own vector is skipped, so it is answered from the others.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.operators import answers
from textlake.operators.nearest import nearest, relevant
from textlake.operators import vector_index
from textlake.operators.rerank import rerank, retrieve_and_rerank
from textlake.plans.views import WRAPPED_SQL, table, wrapped_documents
from textlake.session import work_path

# Few of the given vectors lie within the default threshold; more do in this one.
WIDE_THRESHOLD = 1.4
# Neighbours that the share found is measured on.
RECALL_K = 10


def corpus(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def vector_queries(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def text_queries(spark, folder):
    """Queries with the text of the document of the same number."""
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").alias("query_id"), F.col("text").alias("query")
    )
    return vector_queries(spark, folder).join(texts, "query_id")


def title_queries(spark, folder):
    """Queries asking for the first line of the document of the same number."""
    return text_queries(spark, folder).withColumn("query", F.substring_index("query", "\n", 1))


def passages(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def hits(spark, folder, k=fixed.TOP_K, **search):
    return nearest(
        vector_queries(spark, folder), corpus(spark, folder), k, skip_same_id=True, **search
    )


def built_index(spark, folder, **settings):
    """All vectors in a new index."""
    index = vector_index.VectorIndex(spark, work_path(spark, "index"))
    vector_index.build_index(corpus(spark, folder), index, **settings)
    return index


def pruned_hits(spark, folder, metric="sq_l2", **search):
    """The exact search that reads only cells which can hold a neighbour."""
    return vector_index.search_exact(
        vector_queries(spark, folder), built_index(spark, folder, metric=metric), skip_same_id=True, **search
    )


def extended_hits(spark, folder):
    """The exact search over an index of the even ids, extended by the others."""
    index = vector_index.VectorIndex(spark, work_path(spark, "index"))
    vectors = corpus(spark, folder)
    vector_index.build_index(vectors.where("doc_id % 2 = 0"), index)
    vector_index.extend_index(vectors.where("doc_id % 2 = 1"), index)
    return vector_index.search_exact(vector_queries(spark, folder), index, skip_same_id=True)


def search_recall(spark, folder):
    """What a search with measured probes finds of the nearest to each vector whose id 50 divides."""
    asked = vector_queries(spark, folder).where("query_id % 50 = 0")
    index = built_index(spark, folder)
    vector_index.tune_index(index, RECALL_K, 0.98)
    found = vector_index.search(asked, index, RECALL_K, skip_same_id=True)
    wanted = nearest(asked, corpus(spark, folder), RECALL_K, skip_same_id=True)
    return vector_index.recall(found, wanted)


def search_recall_reached(spark, folder):
    return search_recall(spark, folder).select("queries", "wanted", (F.col("recall") >= 0.9).alias("reached"))


def rounded(ranked):
    return ranked.withColumn("distance", F.round("distance", 4))


def reranked(spark, folder):
    return retrieve_and_rerank(
        text_queries(spark, folder), corpus(spark, folder), passages(spark, folder),
        skip_same_id=True,
    )


def rerank_topk(spark, folder):
    found = hits(spark, folder, fixed.CANDIDATE_K)
    best = rerank(text_queries(spark, folder), found, passages(spark, folder))
    return best.select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


def wide_hits(spark, folder):
    return relevant(hits(spark, folder), WIDE_THRESHOLD)


def context_cited(spark, folder):
    found = answers.with_documents(wide_hits(spark, folder), wrapped_documents(spark, folder))
    return answers.cited_context(found).select("query_id", "context")


def prompts(spark, folder):
    """The one-shot prompt over the reranked passages of each query."""
    contexts = answers.plain_context(reranked(spark, folder))
    return (
        title_queries(spark, folder)
        .join(contexts, "query_id", "left")
        .select(
            "query_id",
            answers.document_prompt(F.coalesce("context", F.lit("")), F.col("query")).alias("prompt"),
            answers.translation_prompt(F.col("query")).alias("translation_prompt"),
        )
    )


def model_answers(spark, folder):
    """What a batch model might give: an answer to every query."""
    return title_queries(spark, folder).select(
        "query_id", F.concat(F.lit("About "), "query").alias("answer")
    )


def _answers(spark, folder, **options):
    rows = answers.answer_queries(
        title_queries(spark, folder), corpus(spark, folder), wrapped_documents(spark, folder),
        skip_same_id=True, **options,
    )
    entry = lambda s: F.concat_ws(
        "|", s["title"], s["link"], s["source"], s["published"], s["sentiment"],
        F.format_string("%.4f", s["score"]),
    )
    return rows.withColumn("sources", F.array_join(F.transform("sources", entry), "\n"))


QUERIES = {
    "vector_topk": lambda s, d: rounded(hits(s, d)),
    "vector_topk_many_queries": lambda s, d: rounded(
        hits(s, d, block_bytes=128 * 1024)
    ),
    "vector_topk_cosine": lambda s, d: rounded(hits(s, d, metric="cosine")),
    "vector_topk_pruned": lambda s, d: rounded(pruned_hits(s, d)),
    "vector_topk_pruned_many_queries": lambda s, d: rounded(pruned_hits(s, d, block_bytes=128 * 1024)),
    "vector_topk_pruned_cosine": lambda s, d: rounded(pruned_hits(s, d, metric="cosine")),
    "vector_topk_extended": lambda s, d: rounded(extended_hits(s, d)),
    "vector_search_recall": search_recall_reached,
    "relevance_filter": lambda s, d: rounded(relevant(hits(s, d))),
    "relevance_filter_wide": lambda s, d: rounded(wide_hits(s, d)),
    "rerank_topk": rerank_topk,
    "retrieve_and_rerank": lambda s, d: reranked(s, d).select(
        "query_id", "doc_id", "rank", "passage"
    ),
    "context_plain": lambda s, d: answers.plain_context(reranked(s, d)),
    "context_cited": context_cited,
    "prompt_rows": prompts,
    "answer_rows": lambda s, d: _answers(s, d, threshold=WIDE_THRESHOLD),
    "answer_rows_answered": lambda s, d: _answers(
        s, d, threshold=WIDE_THRESHOLD, model_answers=model_answers(s, d)
    ),
    "answer_rows_retrieval_only": lambda s, d: _answers(s, d, use_model=False),
}


def hits_sql(k: int, metric: str = "sq_l2") -> str:
    near = "list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[])"
    distance = f"{near} * {near}"
    if metric == "cosine":
        distance = "1 - list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[])"
    return f"""
hits AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id)
      AS INTEGER) AS rank
    FROM (SELECT q.vec_id AS query_id, c.vec_id AS doc_id, {distance} AS distance
          FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id))
  WHERE rank <= {k})"""


RERANKED_SQL = rf"""{hits_sql(fixed.CANDIDATE_K)},
words AS MATERIALIZED (
  SELECT doc_id, text, list_distinct(list_filter(
    string_split_regex(lower(text), '\s+'), lambda w: w <> '')) AS words FROM documents),
scored AS (
  SELECT h.query_id, h.doc_id, p.text AS passage,
    len(list_intersect(q.words, p.words))
      / len(list_distinct(list_concat(q.words, p.words))) AS score
  FROM hits h JOIN words q ON h.query_id = q.doc_id JOIN words p ON h.doc_id = p.doc_id),
reranked AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)
      AS INTEGER) AS rank FROM scored)
  WHERE rank <= {fixed.RERANK_K}),
contexts AS (
  SELECT query_id, string_agg(passage, chr(10) || chr(10) ORDER BY rank) AS context
  FROM reranked GROUP BY query_id)"""

TITLES_SQL = """
queries AS (
  SELECT vec_id AS query_id, split_part(text, chr(10), 1) AS query
  FROM embeddings JOIN documents ON vec_id = doc_id)"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def template_sql(template: str, **values: str) -> str:
    """A template in SQL; no value of the queries here holds a place of another."""
    text = sql_text(template)
    for name, value in values.items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return text


def cited_sql(threshold: float, asked: str = "") -> str:
    return f"""{hits_sql(fixed.TOP_K)}, {WRAPPED_SQL},
cited AS (
  SELECT h.query_id, h.rank, '[' || h.rank || '] ' || split_part(page_content, chr(10), 1)
      || chr(10) || CASE WHEN contains(page_content, chr(10)) THEN
        trim(substr(page_content, instr(page_content, chr(10)) + 1), chr(32) || chr(9) || chr(10))
        ELSE '' END
      || chr(10) || 'Source: ' || source || ' | Link: ' || link || ' | Published: ' || published
      || ' | Sentiment: ' || sentiment AS block,
    concat_ws('|', split_part(page_content, chr(10), 1), link, source, published, sentiment,
      printf('%.4f', round(distance, 4))) AS entry
  FROM hits h JOIN wrapped w ON h.doc_id = w.doc_id WHERE distance <= {threshold}),
contexts AS (
  SELECT query_id, string_agg(block, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(entry, chr(10) ORDER BY rank) AS sources
  FROM cited GROUP BY query_id)"""


def answers_sql(threshold: float, status: str, answer: str) -> str:
    return f"""WITH {cited_sql(threshold)}, {TITLES_SQL}
SELECT query_id, query,
  CASE WHEN context IS NOT NULL THEN '{status}'
       WHEN query_id IN (SELECT query_id FROM hits WHERE distance <= {threshold}) THEN 'text_missing'
       ELSE 'nothing_found' END AS status,
  CASE WHEN context IS NULL THEN {sql_text(fixed.ANSWER_NOTHING_FOUND)}
       ELSE {answer} END AS answer,
  coalesce(sources, '') AS sources, coalesce(context, '') AS context,
  CASE WHEN context IS NOT NULL THEN
    {template_sql(fixed.NEWS_PROMPT, context="context", question="query")} END AS prompt
FROM queries LEFT JOIN contexts USING (query_id)"""


def _ranked(source: str) -> str:
    return f"SELECT query_id, doc_id, rank, round(distance, 4) AS distance FROM {source}"


ORACLES = {
    "vector_topk": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')}",
    "vector_topk_many_queries": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')}",
    "vector_topk_cosine": f"WITH {hits_sql(fixed.TOP_K, 'cosine')} {_ranked('hits')}",
    "vector_topk_pruned": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')}",
    "vector_topk_pruned_many_queries": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')}",
    "vector_topk_pruned_cosine": f"WITH {hits_sql(fixed.TOP_K, 'cosine')} {_ranked('hits')}",
    "vector_topk_extended": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')}",
    "vector_search_recall": f"""
        SELECT count(*) AS queries, {RECALL_K} * count(*) AS wanted, true AS reached
        FROM embeddings WHERE vec_id % 50 = 0""",
    "relevance_filter": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')} "
    f"WHERE distance <= {fixed.RELEVANCE_THRESHOLD}",
    "relevance_filter_wide": f"WITH {hits_sql(fixed.TOP_K)} {_ranked('hits')} "
    f"WHERE distance <= {WIDE_THRESHOLD}",
    "rerank_topk": f"WITH {RERANKED_SQL} "
    "SELECT query_id, doc_id, rank, round(score, 6) AS score FROM reranked",
    "retrieve_and_rerank": f"WITH {RERANKED_SQL} "
    "SELECT query_id, doc_id, rank, passage FROM reranked",
    "context_plain": f"WITH {RERANKED_SQL} SELECT query_id, context FROM contexts",
    "context_cited": f"WITH {cited_sql(WIDE_THRESHOLD)} SELECT query_id, context FROM contexts",
    "prompt_rows": f"""WITH {RERANKED_SQL}, {TITLES_SQL}
        SELECT query_id,
          {template_sql(fixed.DOCUMENT_PROMPT, context="coalesce(context, '')", question="query")} AS prompt,
          {template_sql(fixed.TRANSLATION_PROMPT, question="query")} AS translation_prompt
        FROM queries LEFT JOIN contexts USING (query_id)""",
    "answer_rows": answers_sql(
        WIDE_THRESHOLD, "model_unavailable", sql_text(fixed.ANSWER_MODEL_UNAVAILABLE)
    ),
    "answer_rows_answered": answers_sql(WIDE_THRESHOLD, "answered", "'About ' || query"),
    "answer_rows_retrieval_only": answers_sql(
        fixed.RELEVANCE_THRESHOLD, "retrieval_only", sql_text(fixed.ANSWER_RETRIEVAL_ONLY)
    ),
}
