"""Exact nearest neighbours of many queries in a corpus of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions.fixed_values import RELEVANCE_THRESHOLD, TOP_K
from textlake.operators.dedupe import top_per_group
from textlake.session import work_path
from textlake.sources.writers import round_trip

# Query vectors of about this size at most are sent to every executor.
BLOCK_BYTES = 8 * 1024 * 1024
# Corpus vectors of about this size at most are held by a task.
PART_BYTES = 16 * 1024 * 1024
# Query vectors of about this size at most go to one task.
GROUP_BYTES = 64 * 1024 * 1024
# Scores worked out at a time within one task, and pairs measured at a time.
SCORES = 4_000_000
PAIRS = 32_768
# Rows of the corpus of which one minimum is taken.
FOLD = 32


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length == 0, 1, length)


def _place(groups: np.ndarray) -> np.ndarray:
    """The place of each row in its group, from 0, rows in their order."""
    order = np.argsort(groups, kind="stable")
    ordered = groups[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else ordered
    place = np.empty(len(groups), np.int64)
    place[order] = np.arange(len(groups)) - np.repeat(begins, np.diff(np.append(begins, len(groups))))
    return place


class _Held:
    """A part of the corpus, asked by blocks of queries.

    A matrix product in single precision, and the minima of its columns folded ``FOLD`` to one, find who can be among
    the ``k`` nearest, with room for all rounding. Their distances are then worked out one by one in double precision, so
    that equal vectors get exactly equal distances and the smaller id wins, in whatever part they are.
    """

    def __init__(self, ids: pa.Array, vectors: np.ndarray, k: int, metric: str, skip_same_id: bool):
        self.k, self.metric, self.skip = k, metric, skip_same_id
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        vectors = vectors[order]
        if metric == "cosine":
            vectors = _unit(vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            finite = np.isfinite((vectors * vectors).sum(axis=1))
        order, vectors = order[finite], np.ascontiguousarray(vectors[finite])
        # Rows of one id that one query may have to pass over.
        self.spare = 0
        if skip_same_id and len(order):
            sames = ids.take(pa.array(order)).dictionary_encode().indices.drop_null().to_numpy()
            self.spare = int(np.bincount(sames).max()) if len(sames) else 0
        # Of equal vectors, no query can want more than those with the smallest ids.
        if len(order):
            raw = vectors.view(np.dtype((np.void, vectors.strides[0]))).ravel()
            kept = _place(np.unique(raw, return_inverse=True)[1].ravel()) < k + self.spare
            order, vectors = order[kept], vectors[kept]
        self.ids, self.vectors = ids.take(pa.array(order)), vectors
        n, self.dims = vectors.shape
        self.fold = max(1, min(FOLD, n // (4 * (k + self.spare))))
        self.width = -(-n // self.fold)
        # Around their middle and within a ball of radius one, single precision serves vectors of any size.
        self.middle = vectors.mean(axis=0) if n else np.zeros(self.dims)
        near = vectors - self.middle
        norms = (near * near).sum(axis=1)
        self.scale = float(np.sqrt(norms.max(initial=0))) or 1.0
        near, norms = near / self.scale, norms / self.scale**2
        self.sides = np.zeros((self.dims + 1, self.fold * self.width), np.float32)
        self.sides[: self.dims, :n] = -2 * near.T
        self.sides[self.dims, :n] = norms
        self.sides[self.dims, n:] = np.finfo(np.float32).max

    def __len__(self) -> int:
        return len(self.ids)

    def _met(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows, of the queries and of the corpus, among which the nearest are."""
        n, m, wanted = len(self.ids), len(queries), self.k + self.spare
        if n <= wanted:
            return np.repeat(np.arange(m), n), np.tile(np.arange(n), m)
        with np.errstate(over="ignore", invalid="ignore"):
            asked = (queries - self.middle) / self.scale
            slack = (2 * self.dims + 16) * 2.0**-23 * (np.sqrt((asked * asked).sum(axis=1)) + 1) ** 2
            asked = np.append(asked, np.ones((m, 1)), axis=1).astype(np.float32)
            scores = (asked @ self.sides).reshape(m, self.fold, self.width)
            least = scores.min(axis=1)
            # So many columns have a row as near as this.
            limit = np.partition(least, wanted - 1, axis=1)[:, wanted - 1] + slack
            # What is no number may be near; it is measured.
            at, column = np.nonzero(~(least > limit[:, None]))
            pair, fold = np.nonzero(~(scores[at, :, column] > limit[at, None]))
        at, who = at[pair], fold * self.width + column[pair]
        real = who < n
        return at[real], who[real]

    def best(self, query_ids: pa.Array, queries: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``query_id, doc_id, distance`` of the ``k`` nearest to each query."""
        if not len(self):
            return
        if self.metric == "cosine":
            queries = _unit(queries)
        kinds = query_ids.type, self.ids.type
        number = lambda t: pa.types.is_integer(t) or pa.types.is_floating(t) or pa.types.is_decimal(t)
        same = self.skip and (kinds[0] == kinds[1] or all(map(number, kinds)))
        step = max(1, SCORES // (self.fold * self.width))
        for start in range(0, len(queries), step):
            block = queries[start : start + step]
            at, who = self._met(block)
            distance = np.empty(len(at))
            with np.errstate(over="ignore", invalid="ignore"):
                for low in range(0, len(at), PAIRS):
                    gap = block[at[low : low + PAIRS]] - self.vectors[who[low : low + PAIRS]]
                    distance[low : low + PAIRS] = (gap * gap).sum(axis=1)
            if self.metric == "cosine":
                distance /= 2
            can = np.isfinite(distance)
            if same:
                own = pc.equal(query_ids.take(pa.array(at + start)), self.ids.take(pa.array(who)))
                can &= ~own.fill_null(False).to_numpy(zero_copy_only=False)
            at, who, distance = at[can], who[can], distance[can]
            # Rows of the corpus are in the order of their ids.
            order = np.lexsort((who, distance, at))
            order = order[_place(at[order]) < self.k]
            yield pa.RecordBatch.from_arrays(
                [
                    query_ids.take(pa.array(at[order] + start)),
                    self.ids.take(pa.array(who[order])),
                    pa.array(distance[order]),
                ],
                names=["query_id", "doc_id", "distance"],
            )


def _best(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    metric: str,
    skip_same_id: bool,
) -> pd.DataFrame:
    """The ``k`` nearest of one block of the corpus for each query."""
    held = _Held(pa.array(ids, from_pandas=True), vectors, k, metric, skip_same_id)
    asked = pa.array(query_ids, from_pandas=True)
    none = pd.DataFrame({"query_id": query_ids[:0], "doc_id": ids[:0], "distance": np.empty(0)})
    return _cut(pd.concat([none, *(hits.to_pandas() for hits in held.best(asked, queries))]), k)


def _cut(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    hits = hits.sort_values(["query_id", "distance", "doc_id"])
    return hits[hits.groupby("query_id").cumcount().to_numpy() < k]


def _nearest_of(hits: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest for each query among the hits of several parts."""
    keys = [(name, "ascending") for name in ("query_id", "distance", "doc_id")]
    hits = hits.take(pc.sort_indices(hits, sort_keys=keys))
    groups = _array(hits["query_id"].dictionary_encode(null_encoding="encode").unify_dictionaries()).indices
    return hits.filter(pa.array(_place(groups.to_numpy()) < k))


def _bytes(vectors: DataFrame, key: str) -> Column:
    width = F.size("embedding") * 8 + F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    metric: str = "sq_l2",
    skip_same_id: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` nearest corpus vectors of each query: ``query_id, doc_id, rank, distance``.

    ``queries`` has ``query_id, embedding`` and ``corpus`` has ``doc_id,
    embedding``; ids are unique. The distance is the squared Euclidean one, or
    with ``metric="cosine"`` one minus the cosine. Ties go to the smaller id.

    A first job measures the queries. Few of them are sent to all executors, and
    every corpus partition is read once, where it is. Many, beyond ``block_bytes``, are shuffled
    with the corpus: parts of the corpus meet groups of queries, each pair of them in a task
    that holds the part, of a fixed size, and reads the queries as they come. A task gives ``k``
    rows per query, never the scores of all its pairs. The hits are stored, as callers read them
    more than once.
    """
    if metric not in ("sq_l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    queries = queries.select("query_id", "embedding").where("embedding is not null")
    held = corpus.select("doc_id", "embedding").where("embedding is not null")
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    size = queries.agg(_bytes(queries, "query_id")).first()["bytes"]
    find = _scan if size <= block_bytes else _meet
    hits = find(queries, held, size, k, metric, skip_same_id, schema)
    ranked = top_per_group(hits, ["query_id"], ["distance", "doc_id"], k)
    ranked = ranked.select("query_id", "doc_id", "rank", "distance")
    return round_trip(ranked, work_path(corpus.sparkSession, "hits"))


def _scan(queries, corpus, size, k, metric, skip_same_id, schema) -> DataFrame:
    few = queries.toArrow()
    if not few.num_rows:
        return corpus.sparkSession.createDataFrame([], schema)
    sent = corpus.sparkSession.sparkContext.broadcast(
        (_array(few["query_id"]), _matrix(few["embedding"], few.num_rows))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = sent.value
        best = []
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("embedding"), batch.num_rows)
            best += _Held(batch.column("doc_id"), vectors, k, metric, skip_same_id).best(query_ids, matrix)
            if best:
                best = _nearest_of(pa.Table.from_batches(best), k).combine_chunks().to_batches()
        yield from best

    return corpus.mapInArrow(score, schema)


def _meet(queries, corpus, size, k, metric, skip_same_id, schema) -> DataFrame:
    """The hits of every group of queries in every part of the corpus, each pair of them in a task."""
    tasks = 2 * corpus.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(corpus.agg(_bytes(corpus, "doc_id")).first()["bytes"] / PART_BYTES))
    groups = max(math.ceil(tasks / parts), math.ceil(size / GROUP_BYTES))
    kinds = {str(df.schema["embedding"].dataType): df.schema["embedding"].dataType for df in (queries, corpus)}
    kind = T.ArrayType(T.DoubleType()) if len(kinds) > 1 else next(iter(kinds.values()))
    vector = F.col("embedding").cast(kind).alias("embedding")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, key: F.pmod(F.xxhash64(key, "embedding"), F.lit(n)).cast("int")
    none = lambda df, key: F.lit(None).cast(df.schema[key].dataType).alias(key)
    held = corpus.select(
        dealt(parts, "doc_id").alias("part"), each(groups).alias("group"), F.lit(False).alias("asks"),
        none(queries, "query_id"), "doc_id", vector,
    )
    asked = queries.select(
        each(parts).alias("part"), dealt(groups, "query_id").alias("group"), F.lit(True).alias("asks"),
        "query_id", none(corpus, "doc_id"), vector,
    )
    task = (F.col("part") * groups + F.col("group")).alias("task")
    met = held.unionByName(asked).select(task, "asks", "query_id", "doc_id", "embedding")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, held = None, [], None
        for batch in batches:
            keys = 2 * batch.column("task").to_numpy().astype(np.int64)
            keys += batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if low == high:
                    continue
                run, asks = batch.slice(low, high - low), keys[low] % 2
                if keys[low] // 2 != now:
                    now, rows, held = keys[low] // 2, [], None
                if not asks:
                    rows.append(run.select(["doc_id", "embedding"]))
                    continue
                if held is None:
                    table = pa.Table.from_batches(rows) if rows else run.select(["doc_id", "embedding"]).slice(0, 0)
                    width = len(run.column("embedding")[0])
                    vectors = _matrix(table["embedding"], len(table)) if rows else np.empty((0, width))
                    held, rows = _Held(_array(table["doc_id"]), vectors, k, metric, skip_same_id), []
                yield from held.best(run.column("query_id"), _matrix(run.column("embedding"), run.num_rows))

    met = met.repartitionById(parts * groups, "task").sortWithinPartitions("task", "asks")
    return met.mapInArrow(score, schema)


def relevant(hits: DataFrame, threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    """The hits close enough to be about the query; lower is closer."""
    return hits.where(F.col("distance") <= threshold)
