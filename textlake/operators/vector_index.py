"""Vectors stored by cells of the space, for searches that read the cells they need.

``build_index`` fits centres on a bounded sample (k-means), puts every vector of the corpus to the centre
nearest to it, and stores a list for each cell with the cell's radius: how far its farthest vector lies
from the centre. A cell that holds too much is divided once more, by centres of its own.

``search`` sends a query to the cells whose centres are nearest: it may miss a neighbour. How many cells that takes
is measured on stored vectors by ``tune_index``. ``search_exact``
goes on to every other cell that can hold one: a vector in a cell is no nearer to the query than the centre is, less
the radius. So its rows are those of ``nearest.nearest``.

Either way a cell's list is read no more than once a step, however many queries there are. Few queries are sent to
the lists where they lie; many are grouped with the lists by cell. Lists and query groups of more than a
bounded number of rows are divided, so no cell is ever in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions.fixed_values import TOP_K
from textlake.operators.dedupe import top_per_group
from textlake.operators.merge import few
from textlake.operators.nearest import BLOCK_BYTES, SCORES, _best, _cut, _matrix, _unit
from textlake.session import remove_path, work_path
from textlake.sources.versions import Version, VersionedTable
from textlake.sources.writers import round_trip

# Vectors that centres are fitted on, at most; for a cell that is divided again, at most so many of it.
SAMPLE_ROWS, CELL_SAMPLE = 50_000, 5_000
# Centres of the first division, and cells after the second, at most: they are sent to all tasks.
MAX_CENTRES, MAX_CELLS = 4096, 65_536
# Vectors of a cell before it is divided, and that meet a group of queries in one task.
LIST_ROWS = 1_000_000
# Queries that meet a list in one task.
GROUP_QUERIES = 20_000
# Cells that are dealt to bundles at a time within one task.
ASKED = 500_000
# Cells that a query goes to where nothing was measured; vectors that ``tune_index`` measures on, about.
PROBES, TUNE_ROWS = 8, 500


@dataclass(frozen=True)
class Cells:
    """What a search needs to know of the cells: a bounded number of centres, radii and sizes."""

    numbers: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    rows: np.ndarray
    metric: str


class VectorIndex:
    """An index below a path: the lists and the cells, each a versioned table."""

    def __init__(self, spark, root: str):
        self.spark = spark
        self.lists = VersionedTable(spark, f"{root}/lists")
        self.cells = VersionedTable(spark, f"{root}/cells")

    def version(self) -> Version:
        found = self.lists.version()
        if found is None:
            raise ValueError(f"no index was built at {self.lists.root}")
        return found

    def known_cells(self, version: Version) -> Cells:
        rows = self.cells.read(int(version.marks["cells"])).orderBy("cell").toArrow()
        return Cells(
            rows["cell"].to_numpy(),
            _matrix(rows["centre"], rows.num_rows) if rows.num_rows else np.zeros((0, 0)),
            rows["radius"].to_numpy(),
            rows["rows"].to_numpy(),
            version.marks["metric"],
        )


def _points(column, n: int, metric: str) -> np.ndarray:
    vectors = _matrix(column, n)
    return _unit(vectors) if metric == "cosine" else vectors


def _gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of all points from all centres, up to rounding."""
    squares = (points * points).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0))


def _sample(df: DataFrame, n: int, rows: int) -> DataFrame:
    """About ``rows`` of ``n`` rows, by a hash of their id; all of them where there are no more."""
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(rows / n * (1 << 30)))


def _unit_column(df: DataFrame, metric: str) -> DataFrame:
    """The points as lists of doubles; for cosine of length one, vectors of zeros as they are."""
    point = F.transform("embedding", lambda x: x.cast("double"))
    df = df.withColumn("_point", point)
    if metric != "cosine":
        return df
    length = F.sqrt(F.aggregate("_point", F.lit(0.0), lambda total, x: total + x * x))
    return df.withColumn("_length", length).withColumn(
        "_point", F.transform("_point", lambda x: F.when(F.col("_length") > 0, x / F.col("_length")).otherwise(x))
    )


def fit_centres(corpus: DataFrame, n: int, centres: int, metric: str, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Centres by Spark's k-means over a sample of no more than about ``sample_rows`` vectors."""
    points = _unit_column(_sample(corpus, n, sample_rows), metric).select(array_to_vector("_point").alias("features"))
    model = KMeans(k=centres, maxIter=10, seed=1).fit(points)
    return np.array(model.clusterCenters())


def _placed(corpus: DataFrame, numbers: np.ndarray, centres: np.ndarray, owners: np.ndarray | None, metric: str) -> DataFrame:
    """``doc_id, embedding, cell, gap``: the nearest centre; with ``owners``, of those that divide the row's ``cell``."""
    sent = corpus.sparkSession.sparkContext.broadcast((numbers, centres, owners))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, centres, owners = sent.value
        step = max(1, SCORES // len(centres))
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch.column("embedding"), batch.num_rows, metric)
            chosen = np.zeros(len(points), np.int64)
            for at in range(0, len(points), step):
                gaps = _gaps(points[at : at + step], centres)
                if owners is not None:
                    own = batch.column("cell").to_numpy()[at : at + step]
                    gaps[own[:, None] != owners[None, :]] = np.inf
                chosen[at : at + step] = gaps.argmin(axis=1)
            gap = np.sqrt(((points - centres[chosen]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("embedding"), pa.array(numbers[chosen]), pa.array(gap)],
                names=["doc_id", "embedding", "cell", "gap"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in corpus.schema.fields}
    schema = f"doc_id {kinds['doc_id']}, embedding {kinds['embedding']}, cell bigint, gap double"
    return corpus.mapInArrow(place, schema)


def _divided(placed: DataFrame, sizes: dict[int, int], limit: int, metric: str) -> DataFrame:
    """``cell, centre`` for cells of more than ``limit`` vectors, each fitted in a task on a sample of its own."""
    share = {cell: CELL_SAMPLE / n for cell, n in sizes.items()}
    parts = {cell: math.ceil(n / limit) for cell, n in sizes.items()}
    chance = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    rows = _unit_column(placed.where(F.col("cell").isin(list(sizes))).where(draw < chance[F.col("cell")]), metric)

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(frame.sort_values("doc_id")["_point"].to_list())
        centres = np.unique(points, axis=0)
        centres = centres[np.linspace(0, len(centres) - 1, min(parts[key[0]], len(centres))).astype(int)]
        for _ in range(10):
            chosen = _gaps(points, centres).argmin(axis=1)
            for i in np.unique(chosen):
                centres[i] = points[chosen == i].mean(axis=0)
        return pd.DataFrame({"cell": key[0], "centre": list(centres)})

    return rows.groupBy("cell").applyInPandas(fit, "cell bigint, centre array<double>")


def _stored(placed: DataFrame, table: VersionedTable) -> dict[str, list[str]]:
    return table.stage(placed.hint("rebalance", "cell"), "cell")


def _measured(placed: DataFrame) -> DataFrame:
    return placed.groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("rows"))


CELLS = "cell bigint, centre array<double>, radius double, rows bigint"


def _commit(index: VectorIndex, numbers, centres, measured: DataFrame, staged, schema, base, metric, drop) -> Version:
    """First the cells, then the lists, which name the version of the cells."""
    spark = index.spark
    known = {r["cell"]: (r["radius"], r["rows"]) for r in measured.collect()}
    rows = [(int(n), c.tolist(), *known.get(int(n), (0.0, 0))) for n, c in zip(numbers, centres, strict=True)]
    cells = index.cells.replace(spark.createDataFrame(rows, CELLS))
    marks = {"cells": str(cells.number), "metric": metric}
    return index.lists.commit(staged, schema, base, drop, marks)


def build_index(
    corpus: DataFrame,
    index: VectorIndex,
    metric: str = "sq_l2",
    centres: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    list_rows: int = LIST_ROWS,
) -> Version:
    """Store ``doc_id, embedding`` as a new version of the index; rows without a vector are left out.

    There are as many centres as the root of the number of vectors, ``MAX_CENTRES`` at most. They are fitted on about ``sample_rows`` vectors,
    chosen by a hash of their id; every vector is stored. A cell of more than ``list_rows`` is divided by its own centres; where it cannot be,
    as one full of copies, searches divide it by a hash.
    """
    if metric not in ("sq_l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = corpus.sparkSession
    base = index.lists.version()
    work = work_path(spark, "cells")
    corpus = corpus.select("doc_id", "embedding").where("embedding IS NOT NULL")
    try:
        n = corpus.count()
        if not n:
            empty = corpus.selectExpr("*", "cast(null AS bigint) AS cell", "cast(null AS double) AS gap")
            none = spark.createDataFrame([], "cell bigint, radius double, rows bigint")
            return _commit(index, [], [], none, {}, empty.schema, base, metric, None)
        list_rows = max(list_rows, math.ceil(n / (MAX_CELLS - MAX_CENTRES)))
        points = fit_centres(corpus, n, min(centres or math.ceil(math.sqrt(n)), MAX_CENTRES, n), metric, sample_rows)
        numbers = np.arange(len(points))
        placed = round_trip(_placed(corpus, numbers, points, None, metric), f"{work}/placed")
        # A row for each cell: no more than there are centres.
        sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
        large = {cell: size for cell, size in sizes.items() if size > list_rows}
        if large:
            found = _divided(placed, large, list_rows, metric).toArrow()
            owners = found["cell"].to_numpy()
            own = _matrix(found["centre"], found.num_rows)
            new = len(points) + np.arange(len(own))
            again = _placed(placed.where(F.col("cell").isin(list(large))), new, own, owners, metric)
            left = placed.where(~F.col("cell").isin(list(large)))
            placed = round_trip(left.unionByName(again), f"{work}/divided")
            keep = np.array([n not in large for n in numbers])
            numbers = np.concatenate([numbers[keep], new])
            points = np.concatenate([points[keep], own])
        staged = _stored(placed, index.lists)
        return _commit(index, numbers, points, _measured(placed), staged, placed.schema, base, metric, None)
    finally:
        remove_path(spark, work)


def extend_index(corpus: DataFrame, index: VectorIndex) -> Version:
    """A version with more vectors, put to the cells there are; their ids must be new to the index.

    Centres stay what they were fitted to, radii grow: ``search_exact`` stays exact.
    """
    spark = corpus.sparkSession
    base = index.version()
    cells = index.known_cells(base)
    if not len(cells.numbers):
        return build_index(corpus, index, cells.metric)
    work = work_path(spark, "cells")
    try:
        rows = corpus.select("doc_id", "embedding").where("embedding IS NOT NULL")
        placed = round_trip(_placed(rows, cells.numbers, cells.centres, None, cells.metric), f"{work}/placed")
        before = index.cells.read(int(base.marks["cells"])).select("cell", "radius", "rows")
        measured = before.unionByName(_measured(placed)).groupBy("cell")
        measured = measured.agg(F.max("radius").alias("radius"), F.sum("rows").alias("rows"))
        staged = _stored(placed, index.lists)
        return _commit(index, cells.numbers, cells.centres, measured, staged, base.schema, base, cells.metric, ())
    finally:
        remove_path(spark, work)


def tune_index(index: VectorIndex, k: int = TOP_K, target: float = 0.95, rows: int = TUNE_ROWS) -> Version:
    """A version that says how many cells to search so that ``target`` of the ``k`` nearest are found.

    Measured on about ``rows`` stored vectors, chosen by a hash, with their exact neighbours: each neighbour lies in a
    cell that is so many centres away from the query.
    """
    base = index.version()
    cells = index.known_cells(base)
    lists = index.lists.read(base)
    queries = _sample(lists, int(cells.rows.sum()), rows).selectExpr("doc_id AS query_id", "embedding")
    hits = search_exact(queries, index, k, skip_same_id=True).select("query_id", "doc_id")
    # No more than k hits for each query of a bounded sample; of the lists, ids are read.
    where = lists.select("doc_id", "cell").join(few(hits), "doc_id").select("query_id", "cell")
    found = where.join(few(queries), "query_id").toArrow()
    if not found.num_rows:
        return base
    gaps = _gaps(_points(found["embedding"], found.num_rows, cells.metric), cells.centres)
    own = gaps[np.arange(len(gaps)), np.searchsorted(cells.numbers, found["cell"].to_numpy())]
    ahead = np.sort((gaps < own[:, None]).sum(axis=1))
    probes = 1 + int(ahead[math.ceil(target * len(ahead)) - 1])
    return index.lists.commit({}, base.schema, base, (), {"probes": str(probes)})


# Searching.


def _asked(queries: DataFrame, cells: Cells, probes: int, bounded: bool) -> DataFrame:
    """``query_id, embedding, cells``: the cells that each query goes to, if there are any.

    Without ``bounded`` the ``probes`` nearest centres. With it, all others whose vectors may be as near
    as the query's ``bound``; a query without a bound goes to all.
    """
    sent = queries.sparkSession.sparkContext.broadcast(cells)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sent.value
        step = max(1, SCORES // len(cells.numbers))
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch.column("embedding"), batch.num_rows, cells.metric)
            for at in range(0, len(points), step):
                gaps = _gaps(points[at : at + step], cells.centres)
                gaps[:, cells.rows == 0] = np.inf
                # Equally near centres in the order of their numbers, in every run.
                first = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
                wanted = np.zeros(gaps.shape, bool)
                np.put_along_axis(wanted, first, True, axis=1)
                wanted &= np.isfinite(gaps)
                if bounded:
                    bound = batch.column("bound").slice(at, len(gaps)).to_pandas().fillna(np.inf).to_numpy()
                    scale = np.abs(points[at : at + step]).max(initial=0) + np.abs(cells.centres).max(initial=0)
                    slack = 1e-6 * (1 + scale * cells.centres.shape[1])
                    wanted = ~wanted & (gaps - cells.radii <= (np.sqrt(bound) + slack)[:, None]) & np.isfinite(gaps)
                who, where = np.nonzero(wanted)
                ends = np.searchsorted(who, np.arange(len(wanted) + 1)).astype(np.int32)
                asking = pa.array(np.flatnonzero(np.diff(ends)))
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.numbers[where]))
                part = batch.slice(at, len(wanted))
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id"), part.column("embedding"), lists],
                    names=["query_id", "embedding", "cells"],
                ).take(asking)

    kinds = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    return queries.mapInArrow(
        choose, f"query_id {kinds['query_id']}, embedding {kinds['embedding']}, cells array<bigint>"
    )


def _hits_schema(queries: DataFrame, lists: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", lists.schema["doc_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _askers(lists: pa.ListArray) -> dict[int, np.ndarray]:
    """Which rows have a cell in their list, by cell."""
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    cell = lists.flatten().to_numpy()
    order = np.argsort(cell, kind="stable")
    found, begins = np.unique(cell[order], return_index=True)
    return dict(zip(found.tolist(), np.split(owner[order], begins[1:]), strict=True)) if len(found) else {}


def _sent(asked: DataFrame, lists: DataFrame, k: int, metric: str, skip: bool, schema) -> DataFrame:
    """Hits of few queries: they go to the lists, which are read where they are."""
    rows = asked.toArrow().combine_chunks()
    ids, vectors = rows["query_id"].to_pandas().to_numpy(), _matrix(rows["embedding"], rows.num_rows)
    groups = {c: (ids[at], vectors[at]) for c, at in _askers(rows["cells"].combine_chunks()).items()}
    sent = lists.sparkSession.sparkContext.broadcast(groups)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, best = sent.value, None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            doc_ids = batch.column("doc_id").to_pandas().to_numpy()
            vectors = _matrix(batch.column("embedding"), batch.num_rows)
            for c in np.unique(cells):
                own = cells == c
                if int(c) in groups:
                    hits = _best(*groups[int(c)], doc_ids[own], vectors[own], k, metric, skip)
                    best = hits if best is None else _cut(pd.concat([best, hits]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return lists.select("doc_id", "embedding", "cell").mapInArrow(score, schema)


def _bundles(cells: Cells, tasks: int) -> tuple[np.ndarray, dict[int, int]]:
    """A bundle for each cell, and how many parts a bundle has: cells that are read together, ``LIST_ROWS`` vectors a part at most.

    A query goes to a bundle once, whatever the number of its cells there.
    """
    room = min(LIST_ROWS, max(1, math.ceil(cells.rows.sum() / tasks)))
    bundle, number, filled = np.zeros(len(cells.numbers), np.int64), 0, 0
    for i, rows in enumerate(cells.rows.tolist()):
        if filled and filled + rows > room:
            number, filled = number + 1, 0
        bundle[i], filled = number, filled + rows
    sizes = np.bincount(bundle, weights=cells.rows)
    return bundle, {b: max(1, math.ceil(n / LIST_ROWS)) for b, n in enumerate(sizes.tolist())}


def _dealt(asked: DataFrame, numbers: np.ndarray, bundle: np.ndarray) -> DataFrame:
    """``bundle, query_id, embedding, cells``: each query once for a bundle, with its cells in it."""
    sent = asked.sparkSession.sparkContext.broadcast((numbers, bundle))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bundle = sent.value
        # A query may name every cell, so a batch of them is dealt in steps of a bounded number of cells.
        step = max(1, ASKED // max(len(numbers), 1))
        for batch in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
            lists = batch.column("cells")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            cell = lists.flatten().to_numpy()
            own = bundle[np.searchsorted(numbers, cell)]
            # Cells come in the order of their numbers, and so do bundles.
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
            begins = np.flatnonzero(new)
            at = pa.array(owner[begins])
            ends = pa.array(np.append(begins, len(own)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[begins]),
                    batch.column("query_id").take(at),
                    batch.column("embedding").take(at),
                    pa.ListArray.from_arrays(ends, pa.array(cell)),
                ],
                names=["bundle", "query_id", "embedding", "cells"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in asked.schema.fields}
    return asked.mapInArrow(
        deal,
        f"bundle bigint, query_id {kinds['query_id']}, embedding {kinds['embedding']}, cells array<bigint>",
    )


def _grouped(asked: DataFrame, lists: DataFrame, cells: Cells, k: int, skip: bool, schema) -> DataFrame:
    """Hits of many queries: they and the lists are shuffled by bundles of cells, queries ahead of vectors.

    A bundle of more than ``LIST_ROWS`` vectors is dealt to parts, its queries to groups of ``GROUP_QUERIES``; each part
    meets each group in a task of its own. A task holds its queries and reads the vectors as they come.
    """
    spark = asked.sparkSession
    bundle, parts = _bundles(cells, 2 * spark.sparkContext.defaultParallelism)
    queries = _dealt(asked, cells.numbers, bundle)
    # A row for each bundle: no more than there are cells.
    counts = {r["bundle"]: r["count"] for r in queries.groupBy("bundle").count().collect()}
    rows = [(b, parts[b], math.ceil(n / GROUP_QUERIES)) for b, n in counts.items()]
    dealt = F.broadcast(spark.createDataFrame(rows, "bundle bigint, parts bigint, groups bigint"))
    homes = list(zip(cells.numbers.tolist(), bundle.tolist(), strict=True))
    homes = F.broadcast(spark.createDataFrame(homes, "cell bigint, bundle bigint"))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    none = lambda df, name: F.lit(None).cast(df.schema[name].dataType).alias(name)
    one = queries.join(dealt, "bundle").select(
        "bundle", spread("parts").alias("part"), F.pmod(F.xxhash64("query_id"), "groups").alias("group"),
        F.lit(-1).cast("bigint").alias("cell"), "query_id", none(lists, "doc_id"), "embedding", "cells",
    )
    two = lists.join(homes, "cell").join(dealt, "bundle").select(
        "bundle", F.pmod(F.xxhash64("doc_id"), "parts").alias("part"), spread("groups").alias("group"),
        "cell", none(asked, "query_id"), "doc_id",
        F.col("embedding").cast(asked.schema["embedding"].dataType).alias("embedding"), none(asked, "cells"),
    )
    metric = cells.metric

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, asking, best = None, [], None, None
        for batch in batches:
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("bundle", "part", "group", "cell")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if low == high:
                    continue
                *this, cell = keys[low].tolist()
                run = batch.slice(low, high - low)
                if this != key:
                    if best is not None:
                        yield pa.RecordBatch.from_pandas(best, preserve_index=False)
                    key, held, asking, best = this, [], None, None
                if cell < 0:
                    held.append(run.select(["query_id", "embedding", "cells"]))
                    continue
                if asking is None and held:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    ids = rows["query_id"].to_pandas().to_numpy()
                    vectors = _matrix(rows["embedding"], len(ids))
                    asking = _askers(rows["cells"].combine_chunks())
                if asking and cell in asking:
                    who = asking[cell]
                    doc_ids = run.column("doc_id").to_pandas().to_numpy()
                    points = _matrix(run.column("embedding"), run.num_rows)
                    hits = _best(ids[who], vectors[who], doc_ids, points, k, metric, skip)
                    best = hits if best is None else _cut(pd.concat([best, hits]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    met = one.unionByName(two).repartition("bundle", "part", "group")
    return met.sortWithinPartitions("bundle", "part", "group", "cell").mapInArrow(score, schema)


def _hits(queries, index, version, cells, probes, bounded, k, skip, block_bytes, work) -> DataFrame:
    if not len(cells.numbers):
        return queries.sparkSession.createDataFrame([], _hits_schema(queries, index.lists.read(version)))
    asked = round_trip(_asked(queries, cells, probes, bounded), f"{work}/asked-{bounded}")
    # A row for each cell that is asked: no more than there are cells.
    each = asked.select(F.explode("cells").alias("cell")).groupBy("cell").count()
    sizes = {r["cell"]: r["count"] for r in each.collect()}
    lists = index.lists.read(version, [str(c) for c in sizes])
    schema = _hits_schema(queries, lists)
    width = 8 * cells.centres.shape[1] + 32
    if sum(sizes.values()) * width <= block_bytes:
        if not sizes:
            return queries.sparkSession.createDataFrame([], schema)
        return _sent(asked, lists, k, cells.metric, skip, schema)
    return _grouped(asked, lists, cells, k, skip, schema)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    ranked = top_per_group(hits, ["query_id"], ["distance", "doc_id"], k)
    return ranked.select("query_id", "doc_id", "rank", "distance")


def search(
    queries: DataFrame,
    index: VectorIndex,
    k: int = TOP_K,
    probes: int | None = None,
    skip_same_id: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """About the ``k`` nearest vectors of each query, ``query_id, doc_id, rank, distance``, from ``probes`` cells.

    ``queries`` has ``query_id, embedding``; ids are unique. What is found is ordered and measured as ``nearest`` does, but a
    neighbour in another cell is missed. ``probes`` trades time for the share found; by default it is what
    ``tune_index`` measured. Only the lists of cells that some query goes to are read.
    """
    version = index.version()
    probes = probes or int(version.marks.get("probes", PROBES))
    queries = queries.select("query_id", "embedding").where("embedding IS NOT NULL")
    work = work_path(queries.sparkSession, "search")
    cells = index.known_cells(version)
    hits = _hits(queries, index, version, cells, probes, False, k, skip_same_id, block_bytes, work)
    return _ranked(hits, k)


def search_exact(
    queries: DataFrame,
    index: VectorIndex,
    k: int = TOP_K,
    probes: int = PROBES,
    skip_same_id: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows that ``nearest`` gives, from the cells that can hold them.

    A first step finds ``k`` vectors in the ``probes`` nearest cells; the farthest of them bounds how far a
    nearest vector may lie. The second step goes to the other cells that reach into that ball.
    """
    version = index.version()
    spark = queries.sparkSession
    queries = queries.select("query_id", "embedding").where("embedding IS NOT NULL")
    work = work_path(spark, "search")
    cells = index.known_cells(version)
    first = _hits(queries, index, version, cells, probes, False, k, skip_same_id, block_bytes, work)
    first = round_trip(_ranked(first, k), f"{work}/first")
    # Squared distances of the points; a cosine distance is half of that.
    scale = 2 if cells.metric == "cosine" else 1
    bounds = first.where(F.col("rank") == k).select("query_id", (F.col("distance") * scale).alias("bound"))
    bounded = queries.join(bounds, "query_id", "left")
    rest = _hits(bounded, index, version, cells, probes, True, k, skip_same_id, block_bytes, work)
    return _ranked(first.drop("rank").unionByName(rest), k)


def recall(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Over all queries of ``wanted``: ``queries``, hits ``wanted`` and ``found``, and ``recall``, the share found."""
    both = wanted.join(found.select("query_id", "doc_id", F.lit(1).alias("hit")), ["query_id", "doc_id"], "left")
    return both.agg(
        F.countDistinct("query_id").alias("queries"),
        F.count("*").alias("wanted"),
        F.count("hit").alias("found"),
        (F.count("hit") / F.count("*")).alias("recall"),
    )
