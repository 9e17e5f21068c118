"""Searches by cells against the exact scan."""

from __future__ import annotations

import numpy as np
import pytest
from test_nearest import vectors

from textlake.operators import vector_index as vi
from textlake.operators.nearest import nearest

MANY = {"block_bytes": 100}


@pytest.fixture
def index(spark, tmp_path):
    return vi.VectorIndex(spark, str(tmp_path / "index"))


def rows(hits):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["distance"], 9)) for r in hits.collect())


def clustered(seed, centres=12, each=40, dims=6, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return np.float32(np.repeat(middle, each, axis=0) + spread * rng.normal(size=(centres * each, dims)))


@pytest.mark.parametrize("options", [{}, MANY], ids=["sent", "grouped"])
@pytest.mark.parametrize("metric", ["sq_l2", "cosine"])
def test_exact_is_the_scan(spark, index, metric, options):
    points = np.concatenate([clustered(1), np.float32(np.random.default_rng(2).integers(-2, 3, (150, 6)))])
    corpus = vectors(spark, "doc_id", list(range(len(points))), points).repartition(5)
    queries = corpus.where("doc_id % 7 = 0").withColumnRenamed("doc_id", "query_id")
    vi.build_index(corpus, index, metric)
    for skip in (False, True):
        got = vi.search_exact(queries, index, 5, 2, skip, **options)
        wanted = nearest(queries, corpus, 5, metric, skip)
        if metric == "cosine":  # parallel vectors tie up to rounding only
            assert [(q, n, d) for q, n, _, d in rows(got)] == [(q, n, d) for q, n, _, d in rows(wanted)]
        else:
            assert rows(got) == rows(wanted)


@pytest.mark.parametrize("options", [{}, MANY], ids=["sent", "grouped"])
def test_large_cells_are_divided(spark, index, monkeypatch, options):
    """A third of all vectors are equal, and one cell has most of the others; tasks get ten vectors of a cell and five queries."""
    monkeypatch.setattr(vi, "LIST_ROWS", 10)
    monkeypatch.setattr(vi, "GROUP_QUERIES", 5)
    points = np.concatenate([np.ones((200, 6), np.float32), clustered(3, 1, 300), clustered(4, 5, 20)])
    corpus = vectors(spark, "doc_id", list(range(len(points))), points)
    made = vi.build_index(corpus, index, centres=4, list_rows=50)
    cells = index.known_cells(made)
    assert len(cells.numbers) > 6
    assert cells.rows.sum() == len(points)
    assert sorted(cells.rows)[-2] < 200
    queries = corpus.where("doc_id % 9 = 0").withColumnRenamed("doc_id", "query_id")
    assert rows(vi.search_exact(queries, index, 4, 1, True, **options)) == rows(nearest(queries, corpus, 4, skip_same_id=True))


def test_far_cells_are_not_read(spark, index):
    points = clustered(5, spread=0.01)
    corpus = vectors(spark, "doc_id", list(range(len(points))), points)
    version = vi.build_index(corpus, index)
    cells = index.known_cells(version)
    queries = corpus.where("doc_id < 40").withColumnRenamed("doc_id", "query_id")
    assert rows(vi.search_exact(queries, index, 3, 1)) == rows(nearest(queries, corpus, 3))
    asked = vi._asked(queries, cells, 1, False).selectExpr("explode(cells) AS cell").distinct().count()
    bounds = nearest(queries, corpus, 3).where("rank = 3").selectExpr("query_id", "distance AS bound")
    more = vi._asked(queries.join(bounds, "query_id"), cells, 1, True).selectExpr("explode(cells) AS cell").distinct().count()
    assert asked + more <= 6 < len(cells.numbers)
    files = index.lists.read(version, ["0"]).inputFiles()
    assert 0 < len(files) < len(index.lists.read(version).inputFiles())


def test_extended_index_is_exact(spark, index):
    points = np.concatenate([clustered(6), 5 + clustered(7, 3)])
    corpus = vectors(spark, "doc_id", list(range(len(points))), points)
    vi.build_index(corpus.where("doc_id < 300"), index)
    before = index.version()
    vi.extend_index(corpus.where("doc_id >= 300"), index)
    queries = corpus.where("doc_id % 11 = 0").withColumnRenamed("doc_id", "query_id")
    assert rows(vi.search_exact(queries, index, 3, 2)) == rows(nearest(queries, corpus, 3))
    assert index.known_cells(before).rows.sum() == 300
    assert index.lists.read(before).count() == 300


def test_tuned_search_finds_most(spark, index):
    points = np.float32(np.random.default_rng(8).normal(size=(900, 8)))
    corpus = vectors(spark, "doc_id", list(range(900)), points)
    vi.build_index(corpus, index)
    version = vi.tune_index(index, 10, 0.97)
    probes = int(version.marks["probes"])
    assert 1 < probes < len(index.known_cells(version).numbers)
    queries = corpus.where("doc_id % 5 = 0").withColumnRenamed("doc_id", "query_id")
    wanted = nearest(queries, corpus, 10, skip_same_id=True)
    found = vi.recall(vi.search(queries, index, 10, skip_same_id=True), wanted).first()
    assert (found["queries"], found["wanted"]) == (180, 1800)
    assert found["recall"] >= 0.9
    # The order and the distances of what is found are the scan's.
    best = {(q, d): dist for q, _, d, dist in rows(wanted)}
    for q, _, d, dist in rows(vi.search(queries, index, 10, skip_same_id=True)):
        assert best.get((q, d), dist) == dist


@pytest.mark.parametrize("options", [{}, MANY], ids=["sent", "grouped"])
def test_odd_tables(spark, index, options):
    with pytest.raises(ValueError):
        index.version()
    corpus = spark.createDataFrame(
        [("a", [1.0, 0.0], 1), ("b", None, 2), ("c", [0.0, 0.0], 3), ("d", [1.0, 0.0], 4)],
        "doc_id string, embedding array<float>, cell int",
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [9.0, 9.0])], "query_id bigint, embedding array<float>")
    vi.build_index(corpus.limit(0), index)
    assert vi.search_exact(queries, index, 2, **options).count() == vi.search(queries, index, 2).count() == 0
    vi.extend_index(corpus, index)
    for metric in ("sq_l2", "cosine"):
        vi.build_index(corpus, index, metric)
        assert rows(vi.search_exact(queries, index, 2, 1, **options)) == rows(nearest(queries, corpus, 2, metric))
        assert rows(vi.search_exact(queries, index, 9, 1, **options)) == rows(nearest(queries, corpus, 9, metric))
        assert vi.search_exact(queries.limit(0), index, **options).count() == 0
    with pytest.raises(ValueError):
        vi.build_index(corpus, index, "other")


def test_queries_of_many_cells_are_dealt_in_steps():
    import tracemalloc
    from types import SimpleNamespace as Stub

    import pyarrow as pa

    n, cells = 4000, 500
    kinds = {"query_id": "bigint", "embedding": "array<float>"}
    asked = Stub(
        sparkSession=Stub(sparkContext=Stub(broadcast=lambda x: Stub(value=x))),
        schema=Stub(fields=[Stub(name=k, dataType=Stub(simpleString=lambda v=v: v)) for k, v in kinds.items()]),
        mapInArrow=lambda deal, schema: deal,
    )

    def lists(values, width):
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values))

    columns = [pa.array(np.arange(n)), lists(np.ones(4 * n, np.float32), 4), lists(np.tile(np.arange(cells), n), cells)]
    batch = pa.RecordBatch.from_arrays(columns, names=["query_id", "embedding", "cells"])
    deal = vi._dealt(asked, np.arange(cells), np.arange(cells) // 50)
    tracemalloc.start()
    rows = got = 0
    for out in deal(iter([batch])):
        rows, got = rows + out.num_rows, got + len(out.column("cells").flatten())
        assert (out.column("cells").flatten().to_numpy() // 50 == np.repeat(out.column("bundle"), 50)).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 10 * n and got == cells * n
    assert peak < 32 * 1024 * 1024  # all at once it takes more than 48 MB
