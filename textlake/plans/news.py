"""News cleaning, merging and refreshing over ``documents``.

The stored part is the documents that have labels; the fresh part is all of
them, so part of what arrives is known already.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textlake.operators import cleaning, merge
from textlake.operators.dedupe import keep_first
from textlake.operators.key_filters import KeyedStore
from textlake.plans.views import (
    COMMON_NEGATIVE,
    COMMON_POSITIVE,
    RAW_NEWS_SQL,
    first_news_sql,
    news,
    raw_news,
    sentiment_sql,
    table,
)
from textlake.session import work_path
from textlake.sources import writers
from textlake.sources.versions import VersionedTable
from textlake.streaming.refresh import start_refresh
from textlake.streaming.seen_links import start_seen_refresh, stored_counts

WORDS = {"positive": COMMON_POSITIVE, "negative": COMMON_NEGATIVE}


def labelled_part(spark, folder):
    """The raw news whose document has a label."""
    known = table(spark, folder, "labels").select("doc_id")
    return raw_news(spark, folder).join(known, "doc_id", "left_semi").drop("doc_id")


def store(spark, folder):
    return cleaning.clean_news(labelled_part(spark, folder), **WORDS)


def incremental_merge(spark, folder):
    """The store on disk, and all that is new added to it."""
    path = work_path(spark, "store")
    writers.write_parquet(store(spark, folder), path)
    merge.append_new_items(news(spark, folder), path, **WORDS)
    return spark.read.parquet(path)


def stream_refresh(spark, folder):
    """Two landings, the second repeating the first, each taken in by a run."""
    root = work_path(spark, "refresh")
    landing, target = f"{root}/landing", f"{root}/store"

    def run():
        start_refresh(spark, landing, target, f"{root}/checkpoint", **WORDS).awaitTermination()

    writers.land_json(labelled_part(spark, folder), landing, "2026-09-11")
    run()
    writers.land_json(news(spark, folder), landing, "2026-09-12")
    run()
    return spark.read.parquet(target)


def keyed_store(spark, folder):
    """The stored part, with a filter of the links in each of its files."""
    keyed = KeyedStore(spark, work_path(spark, "keyed"))
    keyed.add(store(spark, folder))
    return keyed


def filtered_merge(spark, folder):
    """All news added twice to the keyed store."""
    keyed = keyed_store(spark, folder)
    for _ in range(2):
        keyed.append_new(news(spark, folder), **WORDS)
    return keyed.rows.read()


def seen_store(spark, folder):
    """Three landings, of which the second repeats the first and the last is late: links are known by the stream's state."""
    root = work_path(spark, "seen")
    store_ = VersionedTable(spark, f"{root}/store")

    def run(items, day):
        writers.land_json(items, f"{root}/landing", day)
        start_seen_refresh(spark, f"{root}/landing", store_, f"{root}/checkpoint", **WORDS).awaitTermination()

    known = labelled_part(spark, folder)
    run(known, "2026-09-11")
    run(news(spark, folder), "2026-09-12")
    run(known, "2026-09-10")
    return store_


QUERIES = {
    "dedupe_keep_first": lambda s, d: keep_first(
        table(s, d, "documents").select("doc_id", "text", "source"), ["text"], ["doc_id"]
    ),
    "news_clean": lambda s, d: cleaning.clean_news(news(s, d)),
    "sentiment_label": lambda s, d: cleaning.label_news(raw_news(s, d), **WORDS).select(
        "doc_id", "sentiment"
    ),
    "sentiment_whole_word": lambda s, d: cleaning.label_news(
        raw_news(s, d), **WORDS, whole_word=True
    ).select("doc_id", "sentiment"),
    "sentiment_counts": lambda s, d: cleaning.count_per_group(
        cleaning.clean_news(news(s, d), **WORDS), "sentiment"
    ),
    "items_per_source": lambda s, d: cleaning.count_per_group(news(s, d), "source"),
    "new_items_anti_join": lambda s, d: merge.new_items(
        cleaning.titled(news(s, d)), store(s, d)
    ),
    "merge_union": lambda s, d: merge.merge_items(store(s, d), news(s, d), **WORDS).select(
        "link", "source", "title", "published", "summary", "text_combined", "sentiment"
    ),
    "incremental_merge": incremental_merge,
    "refresh_summary": lambda s, d: merge.refresh_summary(store(s, d), news(s, d)),
    "stream_refresh": stream_refresh,
    "new_items_filtered": lambda s, d: keyed_store(s, d).new_items(cleaning.titled(news(s, d))),
    "incremental_merge_filtered": filtered_merge,
    "stream_refresh_seen": lambda s, d: seen_store(s, d).read(),
    "stored_sentiment_counts": lambda s, d: stored_counts(seen_store(s, d), "sentiment"),
    "stored_items_per_source": lambda s, d: stored_counts(seen_store(s, d), "source"),
}

COMBINED = "lower(concat_ws(' ', title, summary))"
LABEL = sentiment_sql("text_combined", COMMON_POSITIVE, COMMON_NEGATIVE)
WHOLE_LABEL = (
    rf"CASE WHEN regexp_matches(text_combined, '\b({'|'.join(COMMON_POSITIVE)})\b') "
    r"THEN 'positive' "
    rf"WHEN regexp_matches(text_combined, '\b({'|'.join(COMMON_NEGATIVE)})\b') "
    "THEN 'negative' ELSE 'neutral' END"
)
STORE_SQL = f"""WITH {RAW_NEWS_SQL},
labelled_part AS (SELECT * FROM raw_news WHERE doc_id IN (SELECT doc_id FROM labels)),
{first_news_sql("stored", "labelled_part")}, {first_news_sql("fresh", "raw_news")},
added AS (SELECT * FROM fresh WHERE link NOT IN (SELECT link FROM stored)),
merged AS (
  SELECT *, {COMBINED} AS text_combined
  FROM (SELECT * FROM stored UNION ALL SELECT * FROM added))
"""
MERGED_SQL = (
    STORE_SQL
    + f"""SELECT link, source, title, published, summary, text_combined, {LABEL} AS sentiment
          FROM merged"""
)

ORACLES = {
    "dedupe_keep_first": """
        SELECT doc_id, text, source FROM (
          SELECT doc_id, text, source,
            row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents)
        WHERE place = 1""",
    "news_clean": f"""WITH {RAW_NEWS_SQL}, {first_news_sql("fresh", "raw_news")},
        combined AS (SELECT *, {COMBINED} AS text_combined FROM fresh)
        SELECT *, {sentiment_sql("text_combined")} AS sentiment FROM combined""",
    "sentiment_label": f"""WITH {RAW_NEWS_SQL},
        combined AS (SELECT doc_id, {COMBINED} AS text_combined FROM raw_news)
        SELECT doc_id, {LABEL} AS sentiment FROM combined""",
    "sentiment_whole_word": f"""WITH {RAW_NEWS_SQL},
        combined AS (SELECT doc_id, {COMBINED} AS text_combined FROM raw_news)
        SELECT doc_id, {WHOLE_LABEL} AS sentiment FROM combined""",
    "sentiment_counts": f"""WITH {RAW_NEWS_SQL}, {first_news_sql("fresh", "raw_news")},
        combined AS (SELECT {COMBINED} AS text_combined FROM fresh)
        SELECT {LABEL} AS sentiment, count(*) AS "count" FROM combined GROUP BY 1""",
    "items_per_source": 'SELECT source, count(*) AS "count" FROM documents GROUP BY source',
    "new_items_anti_join": STORE_SQL + "SELECT * FROM added",
    "merge_union": MERGED_SQL,
    "incremental_merge": MERGED_SQL,
    "refresh_summary": STORE_SQL
    + """SELECT (SELECT count(*) FROM added) AS new_news,
                (SELECT count(*) FROM merged) AS total""",
    "stream_refresh": MERGED_SQL,
    "new_items_filtered": STORE_SQL + "SELECT * FROM added",
    "incremental_merge_filtered": MERGED_SQL,
    "stream_refresh_seen": MERGED_SQL,
    "stored_sentiment_counts": f"""SELECT sentiment, count(*) AS "count" FROM ({MERGED_SQL}) GROUP BY ALL""",
    "stored_items_per_source": f"""SELECT source, count(*) AS "count" FROM ({MERGED_SQL}) GROUP BY ALL""",
}
