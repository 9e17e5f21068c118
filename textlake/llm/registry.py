"""The operators as queries over the given tables, and the same as SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from textlake.llm import (
    attention_lm,
    centroid_clusters,
    circulant_minhash,
    conversation_repair,
    decontaminate,
    jaccard_join,
    licenses,
    pii,
    robust_outliers,
    soft_mixing,
    sql,
    suffix_levels,
    token_cache,
    toxicity,
)
from textlake.llm.storage import held_out, table
from textlake.session import shared_folder

TOKENIZER = "word_bpe_49k.json"


def op1_robust_outliers(spark, folder):
    return robust_outliers.quality_rules(table(spark, folder, "documents"))


def op2_attention_lm(spark, folder):
    return attention_lm.score_documents(
        table(spark, folder, "documents"), held_out(F.col("doc_id"), 1), public_tokenizers.path(TOKENIZER)
    )


def op3_jaccard_join(spark, folder):
    return jaccard_join.near_copies(table(spark, folder, "documents"), size=3, percent=90)


def op4_suffix_levels(spark, folder):
    return suffix_levels.remove_repeats(table(spark, folder, "documents"))


def op5_soft_mixing(spark, folder):
    return soft_mixing.document_rates(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_pii(spark, folder):
    return pii.span_digests(pii.pii_spans(table(spark, folder, "documents")))


def op7_toxicity(spark, folder):
    documents = table(spark, folder, "documents")
    model = toxicity.train(documents, table(spark, folder, "labels"), ~held_out(F.col("doc_id"), 0))
    scored = toxicity.score_documents(documents, model)
    return scored.withColumn("held_out", held_out(F.col("doc_id"), 0))


def op8_decontaminate(spark, folder):
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_licenses(spark, folder):
    return licenses.scan_licenses(table(spark, folder, "documents"), licenses.default_templates(spark))


def op10_token_counts(spark, folder):
    return token_cache.count_tokens(
        table(spark, folder, "documents"),
        public_tokenizers.path(TOKENIZER),
        f"{shared_folder(spark)}/textlake/token-cache",
    )


def op11_circulant_minhash(spark, folder):
    return circulant_minhash.near_copies(table(spark, folder, "documents"), size=3, percent=85)


def op12_centroid_clusters(spark, folder):
    return centroid_clusters.cluster_report(table(spark, folder, "embeddings"))


def op13_conversation_repair(spark, folder):
    return conversation_repair.repair_query(table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_robust_outliers,
        op2_attention_lm,
        op3_jaccard_join,
        op4_suffix_levels,
        op5_soft_mixing,
        op6_pii,
        op7_toxicity,
        op8_decontaminate,
        op9_licenses,
        op10_token_counts,
        op11_circulant_minhash,
        op12_centroid_clusters,
        op13_conversation_repair,
    )
}

# The words of a text, and its runs of k of them in lower case.
_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _runs_sql(source: str, key: str, k: int, words: str) -> str:
    return f"""
      SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS s
      FROM (SELECT {key}, {words} AS w FROM {source}),
           LATERAL (SELECT unnest(range(1, len(w) - {k - 2})) AS i)"""


_PLAIN_WORDS = _WORDS.format(text=_LOWER.format(text="coalesce(text, '')"))

ITEMS_SQL = f"""
WITH short AS (
  SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS s
  FROM (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) BETWEEN 1 AND 4),
d AS ({_runs_sql("documents", "doc_id", 5, _PLAIN_WORDS)}
  UNION ALL
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
  FROM (SELECT doc_id, k, {_PLAIN_WORDS} AS w FROM documents, (SELECT DISTINCT k FROM short)),
       LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
b AS ({_runs_sql("benchmark", "item_id", 5, _PLAIN_WORDS)}
  UNION ALL SELECT DISTINCT item_id, s FROM short),
sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
met AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM met JOIN sizes USING (item_id) WHERE 10 * n_shared >= 8 * n_item"""


def _licenses_sql() -> str:
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda x: x <> '')"
    rows = ", ".join(
        "({}, '{}', '{}')".format(i, name, text.replace("'", "''"))
        for i, (name, text) in enumerate(licenses.NOTICES)
    )
    return f"""
WITH notices(template_id, license, text) AS (VALUES {rows}),
d AS ({_runs_sql("documents", "doc_id", 5, words)}),
t AS ({_runs_sql("notices", "template_id, license", 5, words)}),
sizes AS (SELECT template_id, count(*) AS n_template FROM t GROUP BY template_id),
met AS (SELECT doc_id, template_id, license, count(*) AS n_shared FROM d JOIN t USING (s) GROUP BY ALL)
SELECT doc_id, CAST(template_id AS BIGINT) AS template_id, license, n_template, n_shared,
       n_shared / n_template AS containment
FROM met JOIN sizes USING (template_id) WHERE 10 * n_shared >= 8 * n_template"""


ORACLES = {
    "op3_jaccard_join": sql.near_copies_sql(3, 90),
    "op8_decontaminate": ITEMS_SQL,
    "op9_licenses": _licenses_sql(),
    "op11_circulant_minhash": sql.near_copies_sql(3, 85, ", doc_id <= coalesce(m, doc_id) AS kept"),
    "op12_centroid_clusters": sql.clusters_sql(),
    "op13_conversation_repair": sql.repair_sql(),
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
