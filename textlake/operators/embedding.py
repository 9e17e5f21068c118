"""Text to unit-length vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[np.ndarray], np.ndarray]


def unit_length(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a row of zeros stays as it is."""
    vectors = np.asarray(vectors, dtype=np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return vectors / np.where(length == 0, 1, length)


def hashed_words(dims: int = 384) -> Callable[[], Encoder]:
    """An encoder that needs no model: counts of words, each word in a fixed place.

    The place of a word is the number in the first eight hex digits of its MD5,
    modulo ``dims``.
    """

    def place(word: str) -> int:
        return int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % dims

    def encode(texts: np.ndarray) -> np.ndarray:
        words = [text.lower().split() for text in texts]
        codes, different = pd.factorize(np.array(list(chain.from_iterable(words)), dtype=object))
        places = np.fromiter(map(place, different), np.int64, len(different))
        rows = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        counts = np.bincount(rows * dims + places[codes], minlength=len(texts) * dims)
        return counts.reshape(len(texts), dims)

    return lambda: encode


def embed_text(
    df: DataFrame,
    load_encoder: Callable[[], Encoder] | None = None,
    text: str = "text",
    batch_size: int = 1024,
) -> DataFrame:
    """Add ``embedding``, the unit-length vector of a text column.

    A text that the encoder gives a vector of zeros, such as one without words,
    has no direction and gets null: searches leave it out, and a question like
    it finds nothing.

    ``load_encoder`` runs once in each task and returns a function from an array
    of texts to a matrix of one row each; it gets ``batch_size`` texts at a
    time. Missing text counts as empty.
    """
    load = load_encoder or hashed_words()

    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = load()
        for batch in batches:
            # Vectors leave as they are made: a batch of them would be many times its texts.
            for at in range(0, max(1, len(batch)), batch_size):
                texts = batch.slice(at, batch_size).to_pandas().to_numpy()
                part = unit_length(encode(texts)).astype(np.float32) if len(texts) else np.empty((0, 0), np.float32)
                ends = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel()), mask=pa.array(~part.any(axis=1)))

    vector = F.arrow_udf(embed, "array<float>")
    return df.withColumn("embedding", vector(F.coalesce(F.col(text), F.lit(""))))


def fit_tfidf(df: DataFrame, text: str = "text", dims: int = 384) -> PipelineModel:
    """Word weights of a corpus, for ``embed_tfidf``: one pass, one small vector."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text, outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit"),
        ]
    ).fit(df.select(text))


def embed_tfidf(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``embedding`` from word weights; runs in the JVM, without a model file."""
    return (
        model.transform(df)
        .withColumn("embedding", vector_to_array("_unit", "float32"))
        .drop("_words", "_counts", "_weighted", "_unit")
    )
