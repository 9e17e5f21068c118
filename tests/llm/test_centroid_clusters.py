"""Clusters against whole-number Python, one vector at a time."""

from __future__ import annotations

import contextlib
import hashlib
import io
import math
import random

import pytest

from textlake.llm import centroid_clusters as cc

SMALL = {"clusters": 4, "dims": 3, "scale": 64}
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, clusters, dims, scale, rounds=3, seed="1"):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(scale * x) for x in v]))
    hashed = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(hashed)[:clusters]]
    if not centroids:
        return []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [
            [sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else c
            for k, c in enumerate(centroids)
        ]
    placed = [(i, *near(v)) for i, v in kept]
    out = []
    for i, d, k in placed:
        digest = hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
        out.append((i, k, d, sum(p[1] for p in placed if p[2] == k), sum(p[1] for p in placed), digest))
    return sorted(out, key=str)


def found(spark, rows, parts=3, **settings):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in cc.cluster_report(df, **settings).collect()), key=str)


def test_same_as_plain(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-8, 8) / 8 for _ in range(3)]) for i in range(200)]
    assert found(spark, rows, **SMALL) == found(spark, rows, 7, **SMALL) == plain(rows, **SMALL)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25, -0.25]), (1, [0.5, 0.25, -0.25]), (2, [0.5, 0.25, -0.5]), (None, [0.1, 0.0, 0.0]),
        (3, None), (4, []), (5, [1.0, 2.0]), (6, [1.0, None, 2.0]), (7, [nan, 0.0, 0.0]), (8, [0.0, -inf, 0.0]),
        (9, [1.0, 2.0, 3.0, 4.0]), (10, [-0.0, 0.0, 1e-9]), (11, [-1e-9, 0.0, 0.0]),
    ]
    got = found(spark, rows, **SMALL)
    assert got == plain(rows, **SMALL)
    assert len(got) == 6


def test_equally_near_goes_to_the_first(spark):
    """All vectors equal: the first cluster has all, the others stay where they began."""
    rows = [(i, [0.5, 0.5, 0.5]) for i in range(30)]
    assert {r[1] for r in found(spark, rows, **SMALL)} == {0}
    assert found(spark, rows, **SMALL) == plain(rows, **SMALL)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0])]
    assert found(spark, rows, **SMALL) == plain(rows, **SMALL)
    assert found(spark, [(None, [1.0, 0.0, 0.0])], **SMALL) == []
    assert found(spark, [], **SMALL) == []


def test_components_beyond_a_long(spark):
    rows = [(1, [3e38, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0]), (3, [0.0, 0.0, 0.0])]
    got = found(spark, rows, **SMALL)
    assert len(got) == 3
    assert all(r[2] is not None and r[2] >= 0 for r in got)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_ids_and_columns(spark, kind):
    """Columns named as the operator's own are not looked at."""
    rows = [(i, [i / 16, 0.0, 0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>").selectExpr(
        f"cast(vec_id AS {kind}) AS vec_id", "embedding", "1 AS cluster", "2 AS v", "3 AS distance"
    )
    got = sorted(tuple(r)[1:] for r in cc.cluster_report(df, **SMALL).collect())
    assert got == sorted(r[1:] for r in plain(rows, **SMALL))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "vec_id bigint, embedding array<float>")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        cc.whole_vectors(df, 3).select(cc.nearest_centroid([(1, 2, 3)])).explain("formatted")
    assert "EvalPython" not in out.getvalue() and "InArrow" not in out.getvalue()
