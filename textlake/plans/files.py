"""Readers and writers: tables go out in a format and are read back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from textlake.operators.cleaning import count_per_group
from textlake.plans.documents import html_sql
from textlake.plans.people import PEOPLE_SQL, people
from textlake.plans.views import RAW_NEWS_SQL, news, raw_news, table
from textlake.session import work_path
from textlake.sources import readers, writers

# News files hold about this many items each.
ITEMS_PER_FILE = 500
LANDING_DAY = "2026-09-12"
# Small files that a task reads: Spark alone would give it 32, and a task costs more than those.
FILES_PER_TASK = 1000


def csv_scan_strings(spark, folder):
    path = work_path(spark, "people")
    people(spark, folder).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, readers.PEOPLE)


def csv_scan_inferred(spark, folder):
    path = work_path(spark, "orders")
    orders = table(spark, folder, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )
    orders.write.option("header", True).csv(path)
    read = readers.read_csv(spark, path, infer=True)
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def news_json_scan(spark, folder):
    """Files of one JSON array each, as a crawl writes them."""
    path = work_path(spark, "raw-news")
    items = raw_news(spark, folder)
    files = max(1, math.ceil(items.count() / ITEMS_PER_FILE))
    items.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*readers.NEWS.names))).alias("value")
    ).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json_arrays(spark, f"{path}/part-*")


def news_json_landing(spark, folder):
    path = work_path(spark, "landing")
    for _ in range(2):  # landing a day again replaces it
        writers.land_json(news(spark, folder), path, LANDING_DAY)
    landed = spark.read.schema(readers.NEWS).json(path).drop("feed")
    return landed.withColumn("ingest_date", F.col("ingest_date").cast("string"))


def parquet_round_trip(spark, folder):
    return writers.round_trip(table(spark, folder, "customer"), work_path(spark, "customer"))


def csv_report(spark, folder):
    path = work_path(spark, "report")
    writers.write_csv_report(count_per_group(people(spark, folder), "city"), path)
    return readers.read_csv(spark, path).select("city", F.col("count").cast("bigint"))


def feed_items(spark, folder):
    """One landed feed per language, and one that never landed."""
    path = work_path(spark, "feeds")
    documents = table(spark, folder, "documents").select("lang", "text")
    documents.select(
        "lang",
        F.concat(F.lit("https://news.example.com/"), F.md5("text")).alias("link"),
        F.concat(F.lit("<p>"), F.replace(F.col("text"), F.lit("\n"), F.lit("</p>\n<p>"))).alias(
            "description"
        ),
    ).write.partitionBy("lang").option("rowTag", "item").option("rootTag", "channel").format(
        "xml"
    ).save(path)
    # A folder for each language written, whichever they are; the last never landed.
    langs = [r["lang"] for r in documents.select("lang").distinct().collect()]
    feeds = {lang: f"{path}/lang={lang}" for lang in [*langs, "none"]}
    return readers.read_feeds(spark, feeds)


def feed_outcomes(spark, folder):
    """A feed per language, one of files that are no feeds, and one that never landed."""
    path = work_path(spark, "feeds")
    documents = table(spark, folder, "documents").select("lang", F.col("text").alias("description"))
    documents.write.partitionBy("lang").option("rowTag", "item").option(
        "rootTag", "channel"
    ).format("xml").save(f"{path}/landed")
    table(spark, folder, "benchmark").select("text").write.option("maxRecordsPerFile", 1).text(f"{path}/broken")
    langs = [r["lang"] for r in documents.select("lang").distinct().collect()]
    feeds = {lang: f"{path}/landed/lang={lang}" for lang in langs}
    feeds |= {"broken": f"{path}/broken", "none": f"{path}/none"}
    return (
        readers.feed_outcomes(spark, feeds)
        .groupBy("source", "state")
        .agg(F.sum("items").alias("items"), F.sum("broken").alias("broken"))
    )


def document_dir_scan(spark, folder):
    """A folder tree with one file per document."""
    path = work_path(spark, "texts")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "text")
    tasks = spark.sparkContext.defaultParallelism
    files = writers.write_documents(documents.repartition(tasks, "doc_id"), path, "lang")
    read = readers.read_documents(spark, path, "*.txt").coalesce(max(tasks, math.ceil(files / FILES_PER_TASK)))
    return read.select(F.regexp_extract("doc_id", "lang=([a-z]+)/", 1).alias("lang"), "text")


QUERIES = {
    "csv_scan_strings": csv_scan_strings,
    "csv_scan_inferred": csv_scan_inferred,
    "news_json_scan": news_json_scan,
    "news_json_landing": news_json_landing,
    "parquet_round_trip": parquet_round_trip,
    "csv_report": csv_report,
    "feed_items": feed_items,
    "feed_outcomes": feed_outcomes,
    "document_dir_scan": document_dir_scan,
}

ORACLES = {
    "csv_scan_strings": PEOPLE_SQL + "SELECT id, name, age, city FROM people",
    "csv_scan_inferred": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
          o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
          o_orderpriority FROM orders""",
    "news_json_scan": f"WITH {RAW_NEWS_SQL} "
    "SELECT source, title, link, published, summary FROM raw_news",
    "news_json_landing": f"""WITH {RAW_NEWS_SQL}
        SELECT source, title, link, published, summary, '{LANDING_DAY}' AS ingest_date
        FROM raw_news""",
    "parquet_round_trip": "SELECT * FROM customer",
    "csv_report": PEOPLE_SQL + 'SELECT city, count(*) AS "count" FROM people GROUP BY city',
    "feed_items": f"""
        SELECT lang AS source, '' AS title, 'https://news.example.com/' || md5(text) AS link,
          '' AS published,
          {html_sql("'<p>' || replace(text, chr(10), '</p>' || chr(10) || '<p>')")} AS summary
        FROM documents""",
    "feed_outcomes": """
        SELECT lang AS source, 'read' AS state, count(*) AS items, CAST(0 AS BIGINT) AS broken
        FROM documents GROUP BY lang
        UNION ALL SELECT 'broken', 'broken', 0, count(*) FROM benchmark
        UNION ALL SELECT 'none', 'missing', 0, 0""",
    "document_dir_scan": "SELECT lang, text || chr(10) AS text FROM documents",
}
