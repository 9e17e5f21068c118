"""The table of embedded chunks, keyed by ``doc_id, chunk_no``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions.fixed_values import DIRECTORY_CHUNKS
from textlake.operators.chunking import chunk_documents
from textlake.operators.embedding import Encoder, embed_text
from textlake.operators.dedupe import keep_first
from textlake.operators.merge import few, new_items, not_in
from textlake.session import remove_path, work_path
from textlake.sources.writers import create_if_missing, round_trip

KEY = ("doc_id", "chunk_no")
# Parts of a table that is updated; a change rewrites only the parts it falls in.
BUCKETS = 64


def vector_rows(
    documents: DataFrame,
    size: int = DIRECTORY_CHUNKS[0],
    overlap: int = DIRECTORY_CHUNKS[1],
    load_encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """Chunks of ``doc_id, text, …`` with their vectors and an id of their own."""
    chunks = chunk_documents(documents, size, overlap)
    return embed_text(chunks, load_encoder).withColumn(
        "id", F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string"))
    )


def rebuild_vector_table(rows: DataFrame, path: str, *parts: str) -> None:
    """Replace the whole table; ``rows`` must not come from it."""
    rows.write.mode("overwrite").partitionBy(*parts).parquet(path)


def update_vectors(
    documents: DataFrame,
    path: str,
    size: int = DIRECTORY_CHUNKS[0],
    overlap: int = DIRECTORY_CHUNKS[1],
    load_encoder: Callable[[], Encoder] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Bring the table in line with ``doc_id, text, …``, one row per document.

    Each chunk carries a hash of its document's whole text. Documents the table
    has with the same text are left alone, before anything is embedded; a new one
    is added; a changed one replaces all its chunks. The table lies in parts by a
    hash of ``doc_id``, and a replacement rewrites the parts it falls in. A run
    that fails can be repeated: what it had done already counts as unchanged.
    """
    spark = documents.sparkSession
    marked = keep_first(documents, ["doc_id"]).withColumns(
        {
            "doc_hash": F.md5(F.coalesce("text", F.lit(""))),
            "bucket": F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"),
        }
    )
    create_if_missing(vector_rows(marked.limit(0), size, overlap, load_encoder), path)
    table = spark.read.parquet(path)
    known = table.select("doc_id", "doc_hash").distinct()
    work = work_path(spark, "update")
    todo = round_trip(not_in(marked, known, ["doc_id", "doc_hash"]), f"{work}/changed")
    old = known.join(few(todo.select("doc_id")), "doc_id", "left_semi").select("doc_id").distinct()
    old = round_trip(old, f"{work}/replaced")
    # Documents are told apart before anything is embedded, so each chunk is embedded once.
    fresh = vector_rows(not_in(todo, old, ["doc_id"]), size, overlap, load_encoder).select(*table.columns)
    fresh.write.mode("append").partitionBy("bucket").parquet(path)
    if old.isEmpty():
        remove_path(spark, work)
        return
    replaced = todo.join(few(old), "doc_id", "left_semi")
    changed = vector_rows(replaced, size, overlap, load_encoder).select(*table.columns)
    parts = [r["bucket"] for r in replaced.select("bucket").distinct().collect()]
    kept = not_in(spark.read.parquet(path).where(F.col("bucket").isin(parts)), old, ["doc_id"])
    staged = round_trip(kept.select(*table.columns).unionByName(changed), f"{work}/parts")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "bucket"
    ).parquet(path)
    remove_path(spark, work)


def append_vectors(rows: DataFrame, path: str) -> None:
    """Add the chunks the table does not have; adding the same twice adds nothing."""
    table = rows.sparkSession.read.parquet(path)
    added = new_items(rows, table, KEY).select(*table.columns).persist()
    try:
        if not added.isEmpty():
            added.write.mode("append").parquet(path)
    finally:
        added.unpersist()
