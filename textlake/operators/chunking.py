"""Documents to chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as tx
from textlake.functions.chunks import split_text
from textlake.functions.fixed_values import DIRECTORY_CHUNKS

# Bytes of text that are split at a time.
SLICE_BYTES = 1024 * 1024


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """An array in pieces of about ``size`` bytes, one longer text in a piece of its own size."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64) + 1) // size
    cuts = (np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist()
    for low, high in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        yield texts.slice(low, high - low)


def chunk_array(text: Column, size: int, overlap: int) -> Column:
    """The chunks of a text as an array, worked out in pieces of Arrow batches.

    A batch is of many rows, however long; only the texts of a piece are Python objects at a time.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                chunks = [split_text(t, size, overlap) if t else [] for t in texts.to_pylist()]
                yield pa.array(chunks, pa.list_(pa.string()))

    return split(text)


def chunk_documents(
    documents: DataFrame,
    size: int = DIRECTORY_CHUNKS[0],
    overlap: int = DIRECTORY_CHUNKS[1],
    text: str = "text",
) -> DataFrame:
    """One row per chunk: all other columns, ``chunk_no`` from 0, the chunk's text."""
    others = [name for name in documents.columns if name != text]
    return documents.select(
        *others, F.posexplode(chunk_array(F.col(text), size, overlap)).alias("chunk_no", text)
    )


def wrap_documents(news: DataFrame) -> DataFrame:
    """Each news item as a document: ``doc_id``, ``page_content``, ``metadata``.

    The link is the key of an item and so becomes the id of its document.
    """
    return news.select(
        F.col("link").alias("doc_id"),
        tx.page_content(F.col("title"), F.col("summary")).alias("page_content"),
        tx.metadata(
            F.col("source"), F.col("link"), F.col("published"), F.col("sentiment")
        ).alias("metadata"),
    )
