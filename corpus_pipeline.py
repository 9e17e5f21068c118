"""The corpus pipeline: documents in, documents fit for training out.

Every stage works on what the stage before kept, written as Parquet and read again. All
but the last give the columns of ``documents``; the last adds ``mix_rate`` and ``mix_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm.decontaminate import drop_contaminated
from textlake.llm.jaccard_join import keep_one
from textlake.llm.pii import redact_pii
from textlake.llm.robust_outliers import keep_quality
from textlake.llm.soft_mixing import mixed_documents
from textlake.llm.storage import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return keep_one(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = redact_pii(docs)
    if "n_chars" in clean.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number of copies that brings the domains to their target shares."""
    return mixed_documents(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality", quality),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("private data", private_data),
    ("mixing", mixing),
]
# SQL can express neither the robust estimate nor the mixing: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if scratch.holds(docs):
            scratch.drop(docs)
        docs = done
    return docs
