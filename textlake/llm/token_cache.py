"""Token counts through a stored cache of content digests.

Texts are keyed by the digest of their normalised content (runs of ASCII white space
as one space, which no supported tokenizer with a white-space-dropping splitter
tells apart) and by the digest of the tokenizer file and library version. Counts come from the
cache; each distinct text it lacks is encoded once, and the new counts are appended.

The encoder takes a text apart at ASCII white space. For a tokenizer that drops white
space a text's count is the sum over these pieces, so pieces met before in a task
are looked up (a bounded table) and only new ones reach the tokenizer.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch, read_or
from textlake.llm.words import slices, words

CACHE_SCHEMA = "digest binary, n_tokens bigint"
# Pieces remembered by a worker; beyond it the table starts anew.
REMEMBERED = 500_000
# Pieces joined into one text for the tokenizer.
JOINED = 2000
# A digest is common when it has this part of all rows.
COMMON = 1000

_tokenizers: dict[str, object] = {}
_pieces: dict[str, dict[bytes, int]] = {}


def tokenizer_version(path: str) -> str:
    """Names the tokenizer file's content and the library that reads it."""
    digest = hashlib.sha256(importlib.metadata.version("tokenizers").encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()[:32]


def content_digest(text):
    spaces = F.lit("[\\x20\\x09-\\x0D]+")
    return F.unhex(F.sha2(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), spaces, F.lit(" "))), 256))


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _tokenizers[path] = made
    return _tokenizers[path]


def _encode_pieces(tokenizer, pieces: list[bytes], known: dict[bytes, int]) -> None:
    """Count the tokens of each piece. Pieces go to the tokenizer many at a time."""
    texts = [p.decode("utf-8") for p in pieces]
    for low in range(0, len(pieces), JOINED):
        part = texts[low : low + JOINED]
        sizes = np.array([len(t) + 1 for t in part])
        starts = np.cumsum(sizes) - sizes
        offsets = tokenizer.encode(" ".join(part), add_special_tokens=False).offsets
        at = np.fromiter((o[0] for o in offsets), np.int64, len(offsets))
        owner = np.searchsorted(starts, at, side="right") - 1
        counts = np.bincount(owner, minlength=len(part)).tolist()
        known.update(zip(pieces[low : low + JOINED], counts, strict=True))


def _count_batch(batch: pa.RecordBatch, path: str) -> list[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    known = _pieces.setdefault(path, {})
    out = []
    for piece in slices(batch.column("text")):
        found = words(piece, lower=False)
        raw = piece.data.tobytes()
        _, where, back = np.unique(found.hash, return_index=True, return_inverse=True)
        distinct = [raw[a:b] for a, b in zip(found.start[where], found.end[where], strict=True)]
        if len(known) > REMEMBERED:
            known.clear()
        _encode_pieces(tokenizer, [p for p in distinct if p not in known], known)
        each = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))
        total = np.zeros(len(found.hash) + 1, np.int64)
        np.cumsum(each[back], out=total[1:])
        out.append(total[found.first[1:]] - total[found.first[:-1]])
    counts = np.concatenate(out) if out else np.zeros(0, np.int64)
    return [
        pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(counts)], names=["digest", "n_tokens"]
        )
    ]


def encode_distinct(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """``digest, n_tokens`` for rows of ``digest, text``. Runs the tokenizer on every row."""

    def run(batches):
        for batch in batches:
            yield from _count_batch(batch, tokenizer_path)

    return texts.select("digest", "text").mapInArrow(run, CACHE_SCHEMA)


def count_tokens(
    documents: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    limit: int = 2048,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``doc_id, text``.

    ``cache_path`` is a folder that all executors share; a missing one is an empty
    cache. A null text counts as empty (0 tokens). Equal rows give equal rows back,
    ``doc_id`` may be null, other columns are not looked at, and an empty table
    gives an empty one. A failed run leaves the cache as it was or with whole rows
    added; a digest stored twice (by two runs at once) counts once.
    """
    spark = documents.sparkSession
    rows = documents.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        content_digest(F.col("text")).alias("digest"),
    )
    scratch = Scratch(spark, "token-counts")
    rows = scratch.keep(rows, "digests")
    path = f"{cache_path}/version={tokenizer_version(tokenizer_path)}"
    cached = read_or(spark, path, CACHE_SCHEMA)

    # One row for each digest met, with its stored count. The cache is only looked up, never de-duplicated
    # as a whole: what is stored twice falls together here, where rows are divided by digest already.
    first = rows.groupBy("digest").agg(
        F.count("*").alias("times"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("at")
    )
    met = first.join(cached, "digest", "left").groupBy("digest", "times", "at").agg(F.max("n_tokens").alias("n_tokens"))
    met = scratch.keep(met, "met")

    # One document stands for each digest that the cache lacks.
    missing = met.where("n_tokens IS NULL").select(
        F.col("digest").alias("_digest"), F.col("at.doc_id").alias("_doc_id")
    )
    texts = documents.select("doc_id", "text", content_digest(F.col("text")).alias("digest"))
    chosen = texts.join(
        missing,
        (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")),
        "left_semi",
    )
    fresh = scratch.keep(encode_distinct(chosen, tokenizer_path).dropDuplicates(["digest"]), "fresh")
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(path)

    known = met.where("n_tokens IS NOT NULL").select("digest", "n_tokens", "times")
    counts = known.unionByName(fresh.join(met.select("digest", "times"), "digest"))
    return _with_counts(rows, counts).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the ``n_tokens`` of their digest; ``counts`` says how many rows each has.

    Texts with a thousandth of all rows or more, of which there are a thousand at most, go to the rows; so no
    digest brings a large part of the rows together.
    """
    total = rows.count()
    often = F.col("times") * COMMON >= F.lit(total)
    common = counts.where(often).select("digest", "n_tokens")
    others = counts.where(~often).select("digest", "n_tokens")
    near = rows.join(F.broadcast(common), "digest")
    far = rows.join(F.broadcast(common.select("digest")), "digest", "left_anti")
    return near.unionByName(far.join(others, "digest"))
