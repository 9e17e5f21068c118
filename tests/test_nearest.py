from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from textlake.operators.nearest import _Held, nearest, relevant

MANY = {"block_bytes": 2000}


def vectors(spark, name, ids, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in zip(ids, matrix, strict=True)]
    kind = "string" if isinstance(ids[0], str) else "bigint"
    return spark.createDataFrame(rows, f"{name} {kind}, embedding array<float>")


def brute(query_ids, queries, ids, corpus, k, metric, skip):
    queries, corpus = np.float32(queries).astype(float), np.float32(corpus).astype(float)
    out = []
    for qid, q in zip(query_ids, queries, strict=True):
        if metric == "cosine":
            cosines = corpus @ q / (np.linalg.norm(corpus, axis=1) * np.linalg.norm(q))
            distances = 1 - cosines
        else:
            distances = ((corpus - q) ** 2).sum(axis=1)
        ranked = sorted(
            (round(d, 9), i) for d, i in zip(distances, ids, strict=True) if not (skip and i == qid)
        )
        out += [(qid, i, n + 1, d) for n, (d, i) in enumerate(ranked[:k])]
    return sorted(out)


def collected(hits):
    return sorted(
        (r["query_id"], r["doc_id"], r["rank"], round(r["distance"], 9)) for r in hits.collect()
    )


@pytest.mark.parametrize("options", [{}, MANY], ids=["scan", "pieces"])
@pytest.mark.parametrize("metric", ["sq_l2", "cosine"])
@pytest.mark.parametrize("skip", [False, True])
def test_equals_brute_force(spark, options, metric, skip):
    rng = np.random.default_rng(1)
    # Coarse values, so that ties between different vectors occur as well.
    corpus = rng.integers(1, 4, (120, 5)).astype(float)
    ids = list(range(120))
    queries, query_ids = corpus[:40], ids[:40]
    got = nearest(
        vectors(spark, "query_id", query_ids, queries),
        vectors(spark, "doc_id", ids, corpus).repartition(3),
        4,
        metric=metric,
        skip_same_id=skip,
        **options,
    )
    wanted = brute(query_ids, queries, ids, corpus, 4, metric, skip)
    if metric == "cosine":
        # Parallel vectors tie only up to rounding; compare distances by rank.
        assert [(q, n, d) for q, _, n, d in sorted(collected(got), key=lambda r: (r[0], r[2]))] == [
            (q, n, d) for q, _, n, d in sorted(wanted, key=lambda r: (r[0], r[2]))
        ]
    else:
        assert collected(got) == wanted


@pytest.mark.parametrize("options", [{}, MANY], ids=["scan", "pieces"])
def test_a_corpus_full_of_copies(spark, options):
    corpus = [[1.0, 0.0]] * 300 + [[0.0, 1.0]] * 100 + [[0.6, 0.8]]
    ids = [f"d{i:03}" for i in range(401)]
    got = nearest(
        vectors(spark, "query_id", ["d007", "q"], [[1.0, 0.0], [0.0, 1.0]]),
        vectors(spark, "doc_id", ids, corpus).repartition(5),
        3,
        skip_same_id=True,
        **options,
    )
    assert [(q, d) for q, d, _, _ in collected(got)] == [
        ("d007", "d000"), ("d007", "d001"), ("d007", "d002"),
        ("q", "d300"), ("q", "d301"), ("q", "d302"),
    ]


@pytest.mark.parametrize("options", [{}, MANY], ids=["scan", "pieces"])
def test_fewer_vectors_than_asked_for(spark, options):
    corpus = vectors(spark, "doc_id", [1, 2], [[1.0, 0.0], [0.0, 1.0]])
    queries = vectors(spark, "query_id", [1], [[1.0, 0.0]])
    assert len(collected(nearest(queries, corpus, 10, **options))) == 2
    assert collected(nearest(queries, corpus, 10, skip_same_id=True, **options)) == [(1, 2, 1, 2.0)]
    assert nearest(queries.limit(0), corpus, 3, **options).count() == 0
    assert nearest(queries, corpus.limit(0), 3, **options).count() == 0


def test_missing_vectors_are_left_out(spark):
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, None)], "doc_id bigint, embedding array<float>"
    )
    queries = corpus.withColumnRenamed("doc_id", "query_id")
    assert collected(nearest(queries, corpus, 3)) == [(1, 1, 1, 0.0)]


def test_long_vectors_keep_their_order(spark):
    base = [1e4, -1e4, 1e4]
    corpus = [[base[0] + i, base[1], base[2]] for i in (5, 3, 1, 4, 2)]
    got = nearest(
        vectors(spark, "query_id", [0], [base]), vectors(spark, "doc_id", [5, 3, 1, 4, 2], corpus), 3
    )
    assert [(d, dist) for _, d, _, dist in collected(got)] == [(1, 1.0), (2, 4.0), (3, 9.0)]


def test_arguments_are_checked(spark):
    one = vectors(spark, "query_id", [1], [[1.0]])
    with pytest.raises(ValueError):
        nearest(one, one.withColumnRenamed("query_id", "doc_id"), metric="other")
    with pytest.raises(ValueError):
        nearest(one, one.withColumnRenamed("query_id", "doc_id"), 0)


def test_relevant_keeps_the_threshold_itself(spark):
    hits = spark.createDataFrame([(1.2,), (1.2001,), (0.0,)], "distance double")
    assert sorted(r["distance"] for r in relevant(hits).collect()) == [0.0, 1.2]


def test_jobs_do_not_grow_with_the_queries(spark):
    rng = np.random.default_rng(2)
    corpus = rng.integers(1, 4, (300, 5)).astype(float)
    queries, held = vectors(spark, "query_id", range(300), corpus), vectors(spark, "doc_id", range(300), corpus)
    counts = []
    for n in (60, 300):
        spark.sparkContext.setJobGroup(f"nearest-{n}", "nearest")
        assert nearest(queries.where(f"query_id < {n}"), held, 3, block_bytes=200).count() == 3 * n
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"nearest-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] < 12


def test_hits_are_searched_once(spark):
    rng = np.random.default_rng(3)
    corpus = rng.integers(1, 4, (50, 5)).astype(float)
    found = nearest(vectors(spark, "query_id", range(50), corpus), vectors(spark, "doc_id", range(50), corpus))
    assert "MapInArrow" not in found._jdf.queryExecution().toString()


def test_many_equal_distances_need_little_memory():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((2000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    held = _Held(pa.array(range(2000)), points, 3, "sq_l2", False)
    tracemalloc.start()
    hits = sum(batch.num_rows for batch in held.best(pa.array(range(1500)), np.zeros((1500, 64))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == 4500
    assert peak < 400e6


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-30, 0.0), (1e30, 0.0), (1.0, 1e6)])
@pytest.mark.parametrize("n", [3, 40, 3000])
def test_vectors_of_any_size(scale, offset, n):
    rng = np.random.default_rng(5)
    points = rng.standard_normal((n, 8)) * scale + offset
    asked = np.concatenate([points[:20], rng.standard_normal((20, 8)) * 3 * scale + offset])
    held = _Held(pa.array(range(n)), points, 4, "sq_l2", True)
    ids = pa.array([*range(len(asked) - 20), *range(-20, 0)])
    got = pa.Table.from_batches(list(held.best(ids, asked))).to_pylist()
    wanted = []
    for own, q in zip(ids.to_pylist(), asked, strict=True):
        distance = ((q - points) ** 2).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(n), distance)) if i != own][:4]
        wanted += [(own, int(i), distance[i]) for i in order]
    assert [(r["query_id"], r["doc_id"], r["distance"]) for r in got] == wanted


@pytest.mark.parametrize("options", [{}, MANY], ids=["scan", "pieces"])
def test_ids_that_are_missing_or_repeated(spark, options):
    rows = [(None, [0.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "doc_id bigint, embedding array<float>")
    queries = corpus.withColumnRenamed("doc_id", "query_id").where("query_id = 1").limit(1)
    got = nearest(queries, corpus, 3, skip_same_id=True, **options)
    assert [(r["doc_id"], r["distance"]) for r in got.orderBy("rank").collect()] == [(2, 0.0), (3, 0.0), (None, 1.0)]
