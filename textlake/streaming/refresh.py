"""Incremental refresh: landed items flow into the news table, each link once."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from textlake.operators.chunking import wrap_documents
from textlake.operators.cleaning import label_news, titled
from textlake.operators.embedding import Encoder, embed_text
from textlake.operators.merge import append_new_items, new_items
from textlake.operators.vector_table import append_vectors
from textlake.sources.readers import NEWS
from textlake.sources.writers import create_if_missing, write_parquet


logger = logging.getLogger(__name__)
MARKED_NEWS = StructType([*NEWS.fields, StructField("_corrupt_record", StringType())])


def _parsed(batch: DataFrame, batch_id: int) -> DataFrame:
    """The items of a batch without what could not be parsed."""
    lost = F.col("_corrupt_record").isNotNull()
    seen = batch.agg(F.count("*").alias("all"), F.count_if(lost).alias("lost")).first()
    if seen["lost"]:
        logger.error("batch %s: %s of %s could not be parsed", batch_id, seen["lost"], seen["all"])
        if seen["lost"] == seen["all"]:
            raise ValueError("nothing of the batch can be parsed; are the files arrays?")
    return batch.where(~lost).select(*NEWS.names)


def news_vectors(news: DataFrame, load_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """Labelled news as rows of a vector table, one chunk per item."""
    documents = wrap_documents(news).selectExpr(
        "doc_id", "0 AS chunk_no", "page_content AS text", "metadata"
    )
    return embed_text(documents, load_encoder)


def start_refresh(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    vectors: str | None = None,
    load_encoder: Callable[[], Encoder] | None = None,
    files_per_batch: int = 1000,
    arrays: bool = False,
    **words,
) -> StreamingQuery:
    """Take in the files that landed since the last run, then stop.

    A batch is cleaned and labelled, and only links the table lacks are added;
    with ``vectors`` they are embedded first, into that table. A batch that
    Spark repeats after a failure therefore adds nothing twice: vectors are
    keyed, and an item counts as stored only when all else is done.

    Landed files hold JSON lines, or with ``arrays`` one array of objects each.
    Lines or files that cannot be parsed are left out and their number logged;
    a batch in which nothing can be parsed is an error, as when ``arrays`` is
    missing.
    """
    empty = spark.createDataFrame([], NEWS)
    create_if_missing(label_news(empty), store)
    if vectors is not None:
        create_if_missing(news_vectors(label_news(empty), load_encoder), vectors)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch = _parsed(batch, batch_id)
            if vectors is None:
                append_new_items(batch, store, **words)
                return
            # Worked out once: the store's keys are read once for both tables.
            table = batch.sparkSession.read.parquet(store)
            fresh = label_news(new_items(titled(batch), table), **words).persist()
            if not fresh.isEmpty():
                append_vectors(news_vectors(fresh, load_encoder), vectors)
                write_parquet(fresh.select(*table.columns), store, "append")
            fresh.unpersist()
        finally:
            batch.unpersist()

    return (
        spark.readStream.schema(MARKED_NEWS)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing, multiLine=arrays)
        .select(*MARKED_NEWS.names)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
