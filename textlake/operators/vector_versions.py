"""The table of embedded chunks as committed versions: an update is one commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions.fixed_values import DIRECTORY_CHUNKS
from textlake.operators.chunking import chunk_documents
from textlake.operators.dedupe import keep_first
from textlake.operators.embedding import Encoder, embed_text
from textlake.operators.merge import few, not_in
from textlake.operators.vector_table import BUCKETS
from textlake.session import remove_path, work_path
from textlake.sources.versions import Version, VersionedTable
from textlake.sources.writers import round_trip


def _embedded(chunks: DataFrame, known: DataFrame | None, load_encoder) -> DataFrame:
    """Chunks with ``chunk_hash`` and ``embedding``, dealt by ``bucket``; those that ``known`` has are not embedded.

    Texts are dealt before they are embedded: their vectors are several times their size.
    """
    chunks = chunks.withColumn("chunk_hash", F.sha2("text", 256))
    if known is None:
        return embed_text(chunks.hint("rebalance", "bucket"), load_encoder)
    # One vector for each text; a text without words has none, which is known, too.
    known = known.groupBy("chunk_hash").agg(F.first("embedding").alias("embedding"))
    met = chunks.join(few(known), "chunk_hash")
    new = chunks.join(few(known.select("chunk_hash")), "chunk_hash", "left_anti")
    return embed_text(new.hint("rebalance", "bucket"), load_encoder).unionByName(met.hint("rebalance", "bucket"))


def update_vector_versions(
    documents: DataFrame,
    table: VersionedTable,
    size: int = DIRECTORY_CHUNKS[0],
    overlap: int = DIRECTORY_CHUNKS[1],
    load_encoder: Callable[[], Encoder] | None = None,
    buckets: int = BUCKETS,
) -> Version | None:
    """Bring the table in line with ``doc_id, text, …``, one row per document, in one commit.

    Documents the table has with the same text are left alone. A changed document replaces all its chunks, but only
    chunks whose text its former version did not have are embedded. The table lies in parts by a hash
    of ``doc_id``; parts with a changed document are written anew, new documents are added to theirs.
    Readers see all of the update or nothing of it, and a run that fails changes nothing. Nothing to do commits nothing.
    Two updates at a time: one of them raises ``VersionConflict``. Documents that are not given stay.
    """
    spark = documents.sparkSession
    base = table.version()
    marked = keep_first(documents, ["doc_id"]).withColumns(
        {
            "doc_hash": F.md5(F.coalesce("text", F.lit(""))),
            "bucket": F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"),
        }
    )
    work = work_path(spark, "update")
    try:
        if base is None:
            todo, replaced, known = marked, [], None
        else:
            stored = table.read(base)
            todo = not_in(marked, stored.select("doc_id", "doc_hash").distinct(), ["doc_id", "doc_hash"])
            todo = round_trip(todo, f"{work}/todo")
            if todo.isEmpty():
                return base
            known = stored.join(few(todo.select("doc_id")), "doc_id", "left_semi")
            known = round_trip(known.select("bucket", "chunk_hash", "embedding"), f"{work}/known")
            replaced = [str(r["bucket"]) for r in known.select("bucket").distinct().collect()]
        rows = _embedded(chunk_documents(todo, size, overlap), known, load_encoder).withColumn(
            "id", F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string"))
        )
        if replaced:
            # Files hold one part each, so what stays is written from where it lies.
            kept = not_in(table.read(base, replaced), few(todo.select("doc_id")), ["doc_id"])
            rows = rows.select(*base.schema.names).unionByName(kept)
        # Tasks write few parts each, and a part that is large is written by several.
        staged = table.stage(rows, "bucket")
        if base is not None and not staged and not replaced:
            return base  # new documents without any text
        return table.commit(staged, base.schema if base else rows.schema, base, replaced)
    finally:
        remove_path(spark, work)
