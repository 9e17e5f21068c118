"""Views over the given tables, in Spark and as SQL, that feed the queries.

They shape the tables like the inputs of the operators, with the flaws that the
operators have to deal with. Preparation only; no operator of the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.functions import text as tx
from textlake.functions.text import WHITESPACE
from textlake.operators.cleaning import label_news

# Words that occur in the texts of the given tables.
COMMON_POSITIVE = ["that", "with", "this"]
COMMON_NEGATIVE = ["from", "rewh", "orre", "ononst"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_sql(words: list[str], text: str) -> str:
    return " OR ".join(f"contains({text}, '{word}')" for word in words)


def sentiment_sql(
    text: str,
    positive: list[str] = fixed.POSITIVE_WORDS,
    negative: list[str] = fixed.NEGATIVE_WORDS,
) -> str:
    return (
        f"CASE WHEN {words_sql(positive, text)} THEN 'positive' "
        f"WHEN {words_sql(negative, text)} THEN 'negative' ELSE 'neutral' END"
    )


# All white space a strip removes, as an SQL text.
SPACES_SQL = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def strip_sql(text: str) -> str:
    return f"trim({text}, {SPACES_SQL})"


def raw_news(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as raw news: first line as title, the rest as summary.

    Exact copies share their link. Two sources send no titles: one null, one "".
    """
    text = F.col("text")
    title = (
        F.when(F.col("source") == "src3", F.lit(None))
        .when(F.col("source") == "src7", "")
        .otherwise(F.substring_index(text, "\n", 1))
    )
    rest = F.when(
        F.contains(text, F.lit("\n")), F.substr(text, F.instr(text, "\n") + 1)
    ).otherwise("")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_chars").cast("int"))
    return table(spark, folder, "documents").select(
        "doc_id",
        "source",
        title.alias("title"),
        F.concat(F.lit("https://news.example.com/"), F.md5(text)).alias("link"),
        day.cast("string").alias("published"),
        rest.alias("summary"),
    )


RAW_NEWS_SQL = """
raw_news AS (
  SELECT doc_id, source,
    CASE WHEN source = 'src3' THEN NULL WHEN source = 'src7' THEN ''
         ELSE split_part(text, chr(10), 1) END AS title,
    'https://news.example.com/' || md5(text) AS link,
    CAST(DATE '2024-01-01' + CAST(n_chars AS INTEGER) AS VARCHAR) AS published,
    CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1)
         ELSE '' END AS summary
  FROM documents)"""


def news(spark: SparkSession, folder: str) -> DataFrame:
    return raw_news(spark, folder).drop("doc_id")


def first_news_sql(name: str, source: str) -> str:
    """Titled items of a relation, one per link."""
    return f"""
{name} AS (
  SELECT source, title, link, published, summary FROM (
    SELECT *, row_number() OVER (PARTITION BY link
      ORDER BY source NULLS FIRST, title NULLS FIRST, published NULLS FIRST,
               summary NULLS FIRST) AS place
    FROM {source} WHERE title IS NOT NULL AND title <> '')
  WHERE place = 1)"""


def wrapped_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as labelled documents under their own number."""
    labelled = label_news(raw_news(spark, folder), COMMON_POSITIVE, COMMON_NEGATIVE)
    return labelled.select(
        "doc_id",
        tx.page_content(F.col("title"), F.col("summary")).alias("page_content"),
        tx.metadata(
            F.col("source"), F.col("link"), F.col("published"), F.col("sentiment")
        ).alias("metadata"),
    )


WRAPPED_SQL = f"""{RAW_NEWS_SQL},
labelled AS (
  SELECT *, lower(concat_ws(' ', title, summary)) AS text_combined FROM raw_news),
parts AS (
  SELECT doc_id, source, link, published,
    {strip_sql("coalesce(title, '')")} AS t, {strip_sql("coalesce(summary, '')")} AS s,
    {sentiment_sql("text_combined", COMMON_POSITIVE, COMMON_NEGATIVE)} AS sentiment
  FROM labelled),
wrapped AS (
  SELECT doc_id, source, link, published, sentiment,
    CASE WHEN t <> '' AND s <> '' THEN t || chr(10) || s
         WHEN t <> '' THEN t ELSE s END AS page_content
  FROM parts)"""
