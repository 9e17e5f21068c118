"""Jobs from files to files, to be started with ``spark-submit`` or ``python -m``.

    python -m textlake.jobs people  IN.csv OUT
    python -m textlake.jobs sales   IN.csv OUT
    python -m textlake.jobs news    'IN/*.json' OUT
    python -m textlake.jobs land    OUT NAME=FEED.xml ...
    python -m textlake.jobs refresh LANDING STORE CHECKPOINT [--vectors TABLE | --versions] [--arrays]
    python -m textlake.jobs index   DIRECTORY TABLE [--append | --versions] [--chunk-size N --chunk-overlap N]
    python -m textlake.jobs ask     QUERIES.json STORE TABLE OUT [--top-k N] [--no-model]

``--encoder package.module:function`` names a function that loads a model and
returns an encoder; without it, texts are embedded by their hashed words.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.operators import cleaning
from textlake.operators.answers import answer_queries
from textlake.operators.chunking import wrap_documents
from textlake.operators.embedding import embed_text
from textlake.operators.vector_table import (
    BUCKETS,
    rebuild_vector_table,
    update_vectors,
    vector_rows,
)
from textlake.operators.vector_versions import update_vector_versions
from textlake.session import build_session, object_store_settings, remove_path, work_path
from textlake.sources import readers, writers
from textlake.sources.versions import VersionedTable, read_table
from textlake.streaming.refresh import start_refresh
from textlake.streaming.seen_links import start_seen_refresh, stored_counts


def people(spark: SparkSession, source: str, target: str) -> None:
    raw = readers.read_csv(spark, source, readers.PEOPLE)
    cleaned, kept = cleaning.count_rows(cleaning.clean_people(raw), "people")
    writers.write_parquet(cleaned, target)
    print(f"people: {kept.get['rows']} rows kept")


def sales(spark: SparkSession, source: str, target: str) -> None:
    """Cleaned rows, the report as a table, and the report as one CSV file."""
    raw, seen = cleaning.count_rows(readers.read_csv(spark, source, readers.SALES), "raw sales")
    cleaned, kept = cleaning.count_rows(cleaning.clean_sales(raw), "cleaned sales")
    stored = writers.round_trip(cleaned, f"{target}/cleaned")
    print(f"sales: {seen.get['rows']} rows read, {kept.get['rows']} kept")
    report = writers.round_trip(cleaning.sales_report(stored), f"{target}/report")
    writers.write_csv_report(
        report.orderBy(F.desc("total_revenue"), "category", "region"), f"{target}/report.csv"
    )


def news(spark: SparkSession, source: str, target: str) -> None:
    """Cleaned news as a table, and the number of items with each label."""
    broken = Observation("broken news files")
    raw, seen = cleaning.count_rows(
        readers.read_json_arrays(spark, source, broken=broken), "raw news"
    )
    cleaned, kept = cleaning.count_rows(cleaning.clean_news(raw), "cleaned news")
    stored = writers.round_trip(cleaned, target)
    print(
        f"news: {seen.get['rows']} items read, {kept.get['rows']} kept, "
        f"{broken.get['files']} files could not be parsed"
    )
    cleaning.count_per_group(stored, "sentiment").show()


def land(spark: SparkSession, target: str, *feeds: str) -> None:
    """Landed feed files, given as ``name=path``, as JSON of today."""
    named = dict(feed.split("=", 1) for feed in feeds)
    items = readers.read_feeds(spark, named).persist()
    writers.land_json(items, target)
    cleaning.count_per_group(items, "source").show()
    items.unpersist()
    readers.feed_outcomes(spark, named).where("state <> 'read'").show(truncate=False)


def refresh(
    spark,
    landing,
    store,
    checkpoint,
    vectors=None,
    load_encoder=None,
    arrays=False,
    versions=False,
) -> None:
    """Take in what landed; prints how many items are new and how many there are.

    With ``versions`` the store is a table of committed versions, and the stream itself
    knows the links it has seen.
    """
    if versions:
        table = VersionedTable(spark, store)
        total = lambda: 0 if table.version() is None else stored_counts(table).first()["count"]
        before = total()
        start_seen_refresh(spark, landing, table, checkpoint, arrays=arrays).awaitTermination()
        print(f"NEW_NEWS={total() - before} total={total()}")
        return
    before = writers.rows_stored(spark, store)
    start_refresh(
        spark, landing, store, checkpoint, vectors, load_encoder, arrays=arrays
    ).awaitTermination()
    total = writers.rows_stored(spark, store)
    print(f"NEW_NEWS={total - before} total={total}")


def index(
    spark,
    directory,
    table,
    append=False,
    load_encoder=None,
    size=fixed.DIRECTORY_CHUNKS[0],
    overlap=fixed.DIRECTORY_CHUNKS[1],
    versions=False,
) -> None:
    """All Markdown files below a directory as a vector table.

    With ``append`` the table is brought in line with the files: new ones are
    added, changed ones replaced, and only these are embedded. With ``versions``
    that is done in one commit, to a table that readers see whole at any time.
    """
    documents = readers.read_documents(spark, directory)
    if versions:
        target = VersionedTable(spark, table)
        update_vector_versions(documents, target, size, overlap, load_encoder)
        print(f"index: version {target.version().number}, {target.read().count()} chunks")
        return
    if append:
        update_vectors(documents, table, size, overlap, load_encoder)
    else:
        documents = documents.withColumns(
            {"doc_hash": F.md5("text"), "bucket": F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")}
        )
        rows = vector_rows(documents, size, overlap, load_encoder)
        rebuild_vector_table(rows, table, "bucket")
    print(f"index: {writers.rows_stored(spark, table)} chunks")


def ask(
    spark,
    source,
    store,
    table,
    target,
    top_k=fixed.TOP_K,
    use_model=True,
    load_encoder=None,
) -> None:
    """Answer rows for JSON lines of ``query_id, query`` from a refreshed store."""
    asked = spark.read.schema("query_id string, query string").json(source)
    path = work_path(spark, "queries")
    queries = writers.round_trip(embed_text(asked, load_encoder, "query"), path)
    answers = answer_queries(
        queries,
        read_table(spark, table).select("doc_id", "embedding"),
        wrap_documents(read_table(spark, store)),
        top_k,
        use_model=use_model,
    )
    answers.write.mode("overwrite").json(target)
    remove_path(spark, path)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["people", "sales", "news", "land", "refresh", "index", "ask"])
    parser.add_argument("paths", nargs="+")
    parser.add_argument("--vectors")
    parser.add_argument("--append", action="store_true")
    parser.add_argument("--versions", action="store_true", help="the table has committed versions")
    parser.add_argument("--chunk-size", type=int, default=fixed.DIRECTORY_CHUNKS[0])
    parser.add_argument("--chunk-overlap", type=int, default=fixed.DIRECTORY_CHUNKS[1])
    parser.add_argument("--arrays", action="store_true", help="landed files are JSON arrays")
    parser.add_argument("--top-k", type=int, default=fixed.TOP_K)
    parser.add_argument("--no-model", action="store_true")
    parser.add_argument("--encoder")
    given = parser.parse_args(arguments)
    encoder = None
    if given.encoder:
        module, name = given.encoder.split(":")
        encoder = getattr(importlib.import_module(module), name)
    options = {
        "refresh": {
            "vectors": given.vectors,
            "load_encoder": encoder,
            "arrays": given.arrays,
            "versions": given.versions,
        },
        "index": {
            "append": given.append,
            "load_encoder": encoder,
            "size": given.chunk_size,
            "overlap": given.chunk_overlap,
            "versions": given.versions,
        },
        "ask": {
            "top_k": given.top_k,
            "use_model": not given.no_model,
            "load_encoder": encoder,
        },
    }.get(given.job, {})
    spark = build_session(f"textlake {given.job}", settings=object_store_settings())
    globals()[given.job](spark, *given.paths, **options)


if __name__ == "__main__":
    main()
