"""Labelled documents to learn from: a bounded sample, chosen by a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    documents: DataFrame, labels: DataFrame, usable: Column, rows: int, names: list[str]
) -> DataFrame:
    """``doc_id, text`` and the label columns ``names`` of about ``rows`` labelled documents.

    All of them are taken where there are no more; else a hash of the number decides. As
    its size is bounded the sample is sent to the documents, whose texts are not
    shuffled. Of labels that disagree on a document the largest counts.
    """
    known = labels.where(usable & F.col("doc_id").isNotNull())
    for name in names:
        known = known.where(F.col(name).isNotNull())
    n = known.count()
    if n > rows:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
        known = known.where(part < int(rows / n * (1 << 20)))
    chosen = known.groupBy("doc_id").agg(*[F.max(x).cast("int").alias(x) for x in names])
    texts = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    return texts.join(F.broadcast(chosen), "doc_id")
