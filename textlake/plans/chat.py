"""Conversations: histories, dropped sessions, prompts and query clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.functions import text as tx
from textlake.operators import sessions
from textlake.operators.answers import plain_context
from textlake.operators.rerank import retrieve_and_rerank
from textlake.plans.retrieval import (
    RERANKED_SQL,
    corpus,
    passages,
    sql_text,
    template_sql,
    text_queries,
)
from textlake.plans.views import strip_sql, table

# Turns in a part: more than the given conversations have, and short parts.
LONG_PART, SHORT_PART = 1000, 3


def messages(spark, folder):
    return table(spark, folder, "conversations")


def toxic_ids(spark, folder):
    """Ids to drop: those labelled toxic, of which only some are conversations."""
    labels = table(spark, folder, "labels")
    return labels.where("toxic = 1").select(F.col("doc_id").alias("conv_id"))


def chat_prompt_rows(spark, folder, part_turns=LONG_PART):
    """The prompt for the last question of each conversation.

    Its context comes from the search for the vector of the same number.
    """
    everything = messages(spark, folder)
    questions = sessions.latest_questions(everything)
    asked = text_queries(spark, folder).join(
        questions.select(F.col("conv_id").alias("query_id")), "query_id", "left_semi"
    )
    found = retrieve_and_rerank(
        asked, corpus(spark, folder), passages(spark, folder), skip_same_id=True
    )
    contexts = plain_context(found).withColumnRenamed("query_id", "conv_id")
    asked = questions.join(contexts, "conv_id", "left")
    return sessions.prompt_parts(
        asked.withColumn("context", F.coalesce("context", F.lit(""))),
        sessions.messages_before(everything, questions),
        part_turns,
    )


def rewrite_prompt_rows(spark, folder):
    """The prompt that turns the last question of a conversation into a query."""
    everything = messages(spark, folder)
    questions = sessions.latest_questions(everything)
    return sessions.prompt_parts(
        questions,
        sessions.messages_before(everything, questions),
        LONG_PART,
        template=fixed.REWRITE_PROMPT,
    )


def query_cleanup(spark, folder):
    """Messages dressed up as rewritten queries; some keep too little, some are null."""
    text = F.col("text")
    rewritten = (
        F.when(F.col("role") == "user", F.concat(F.lit('Rewritten question: "'), text, F.lit('"')))
        .when(F.col("role") == "assistant", F.concat(F.lit("AI: Human:' "), text, F.lit(" User:")))
        .when(F.col("turn") == 0, " 'AI:  short' ")
    )
    return messages(spark, folder).select(
        "conv_id", "turn", tx.clean_rewritten_query(rewritten, text).alias("query")
    )


def translation_cleanup(spark, folder):
    """Messages dressed up as translations; some are empty, some are null."""
    text = F.col("text")
    translated = (
        F.when(F.col("role") == "user", F.concat(F.lit(' english: "'), text, F.lit('"')))
        .when(F.col("role") == "assistant", F.concat(F.lit("Translation: EN:"), text, F.lit(" ")))
        .when(F.col("turn") == 0, "\n''\"\" ")
    )
    return messages(spark, folder).select(
        "conv_id", "turn", tx.clean_translated_query(translated, text).alias("query")
    )


def cjk_flag(spark, folder):
    """Messages of the system get a Chinese word; the others have none."""
    text = F.when(F.col("role") == "system", F.concat("text", F.lit(" 新闻"))).otherwise(
        F.col("text")
    )
    return messages(spark, folder).select("conv_id", "turn", tx.has_cjk(text).alias("is_chinese"))


QUERIES = {
    "session_history": lambda s, d: sessions.history_parts(messages(s, d), LONG_PART),
    "session_history_parts": lambda s, d: sessions.history_parts(messages(s, d), SHORT_PART),
    "drop_sessions": lambda s, d: sessions.drop_sessions(messages(s, d), toxic_ids(s, d)),
    "drop_status": lambda s, d: sessions.drop_status(messages(s, d), toxic_ids(s, d)),
    "chat_prompt_rows": chat_prompt_rows,
    "chat_prompt_parts": lambda s, d: chat_prompt_rows(s, d, SHORT_PART),
    "rewrite_prompt_rows": rewrite_prompt_rows,
    "query_cleanup": query_cleanup,
    "translation_cleanup": translation_cleanup,
    "cjk_flag": cjk_flag,
}

LINES_SQL = """
lines AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'Human' WHEN 'assistant' THEN 'AI'
    WHEN 'system' THEN 'System' ELSE role END || ': ' || text AS line
  FROM conversations)"""


def history_sql(part_turns: int) -> str:
    return f"""WITH {LINES_SQL}
SELECT conv_id, turn // {part_turns} AS part, string_agg(line, chr(10) ORDER BY turn) AS history,
  count(*) OVER (PARTITION BY conv_id) AS n_parts
FROM lines GROUP BY conv_id, turn // {part_turns}"""


QUESTIONS_SQL = """
questions AS (
  SELECT conv_id, max(turn) AS q_turn, arg_max(text, turn) AS question
  FROM conversations WHERE role = 'user' GROUP BY conv_id)"""
ASKED_SQL = """SELECT questions.*, coalesce(context, '') AS context
    FROM questions LEFT JOIN contexts ON conv_id = query_id"""


def chat_prompts_sql(
    part_turns: int, template: str = fixed.CHAT_PROMPT, source: str = ASKED_SQL, **values: str
) -> str:
    before, after = template.split("{chat_history}")
    retrieved = f"{RERANKED_SQL}," if "contexts" in source else ""
    return f"""WITH {retrieved} {LINES_SQL}, {QUESTIONS_SQL},
asked AS (
  SELECT conv_id, q_turn, {template_sql(after, **values)} AS tail FROM ({source})),
parts AS (
  SELECT conv_id, l.turn // {part_turns} AS part, string_agg(line, chr(10) ORDER BY turn) AS history
  FROM lines l JOIN asked USING (conv_id) WHERE turn < q_turn GROUP BY ALL),
ends AS (SELECT conv_id, min(part) AS first, max(part) AS last FROM parts GROUP BY conv_id)
SELECT conv_id, coalesce(part, 0) AS part,
  CASE WHEN part > first THEN chr(10) ELSE {sql_text(before)} END || coalesce(history, '')
    || CASE WHEN part < last THEN '' ELSE tail END AS prompt,
  count(*) OVER (PARTITION BY conv_id) AS n_parts
FROM asked LEFT JOIN parts USING (conv_id) LEFT JOIN ends USING (conv_id)"""


def _stripped_prefixes(text: str) -> str:
    for prefix in fixed.REWRITE_PREFIXES:
        text = f"replace({text}, '{prefix}', '')"
    return strip_sql(f"replace(replace({text}, '\"', ''), '''', '')")


TRANSLATED_SQL = "translated"
for _prefix in fixed.TRANSLATION_PREFIXES:
    TRANSLATED_SQL = f"regexp_replace({TRANSLATED_SQL}, '^(?i){_prefix}\\s*', '')"

ORACLES = {
    "session_history": history_sql(LONG_PART),
    "session_history_parts": history_sql(SHORT_PART),
    "drop_sessions": """
        SELECT * FROM conversations
        WHERE conv_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "drop_status": """
        SELECT DISTINCT doc_id AS conv_id,
          CASE WHEN doc_id IN (SELECT conv_id FROM conversations)
               THEN 'deleted' ELSE 'not_found' END AS status
        FROM labels WHERE toxic = 1""",
    "chat_prompt_rows": chat_prompts_sql(
        LONG_PART, context="context", question="question"
    ),
    "chat_prompt_parts": chat_prompts_sql(SHORT_PART, context="context", question="question"),
    "rewrite_prompt_rows": chat_prompts_sql(
        LONG_PART, fixed.REWRITE_PROMPT, "FROM questions", question="question"
    ),
    "query_cleanup": f"""
        WITH dressed AS (
          SELECT *, CASE role WHEN 'user' THEN 'Rewritten question: "' || text || '"'
            WHEN 'assistant' THEN 'AI: Human:'' ' || text || ' User:'
            WHEN 'system' THEN CASE turn WHEN 0 THEN ' ''AI:  short'' ' END END AS rewritten
          FROM conversations),
        bare AS (SELECT *, {_stripped_prefixes("rewritten")} AS bare FROM dressed)
        SELECT conv_id, turn, CASE WHEN length(coalesce(bare, '')) <= 8 THEN text ELSE bare END AS query
        FROM bare""",
    "translation_cleanup": f"""
        WITH dressed AS (
          SELECT *, {strip_sql('''CASE role WHEN 'user' THEN ' english: "' || text || '"'
            WHEN 'assistant' THEN 'Translation: EN:' || text || ' '
            ELSE CASE turn WHEN 0 THEN chr(10) || '\''\'\'""' || ' ' END END''')} AS translated FROM conversations),
        bare AS (SELECT *, trim({TRANSLATED_SQL}, '"''') AS bare FROM dressed)
        SELECT conv_id, turn, CASE WHEN coalesce(bare, '') = '' THEN text ELSE bare END AS query FROM bare""",
    "cjk_flag": r"""
        SELECT conv_id, turn, regexp_matches(
          CASE WHEN role = 'system' THEN text || ' 新闻' ELSE text END,
          '[\x{4e00}-\x{9fff}]') AS is_chinese FROM conversations""",
}
