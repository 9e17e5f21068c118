"""Near copies by circulant MinHash against all pairs, and the signatures against their definition."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_jaccard_join import brute, made

from textlake.llm import circulant_minhash as cm
from textlake.llm import registry
from textlake.llm.storage import Scratch


def same(spark, rows, k, percent, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sorted(map(tuple, cm.near_copies(docs, k, percent).collect()), key=repr)
    wanted = [(doc, n, c if n else doc) for doc, n, c in brute(rows, k, percent)]
    assert got == sorted(((doc, n, c, doc == c) for doc, n, c in wanted), key=repr)


@pytest.mark.parametrize("seed, k, percent", [(1, 3, 85), (2, 5, 80)])
def test_as_all_pairs(spark, seed, k, percent):
    same(spark, made(seed), k, percent)


def test_buckets_in_many_blocks(spark, monkeypatch):
    """Groups of texts just below and just above the threshold, dealt to blocks and star parts of three nodes."""
    monkeypatch.setattr(cm, "PART", 3)
    draw = random.Random(3)
    rows = []
    for group, changed in enumerate((2, 3, 4)):
        base = [f"g{group}w{i}" for i in range(100)]
        for i in range(40):
            own = list(base)
            for at in draw.sample(range(0, 100, 4), changed):
                own[at] = f"own{group}x{i}x{at}"
            rows.append((len(rows), " ".join(own)))
    draw.shuffle(rows)
    same(spark, rows, 3, 85)


def test_given_documents(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(tuple(r)[:3] for r in registry.op11_circulant_minhash(spark, folder).collect())
    assert got == sorted(brute(rows, 3, 85))


def test_odd_rows(spark):
    long = " ".join(f"v{i % 5000}x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " end")]
    rows += [(None, "one two"), (None, "lonely words here now"), (None, "lonely words here now"), (6, long), (2, "")]
    same(spark, rows, 3, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert cm.near_copies(docs.limit(0)).count() == 0
    assert cm.near_copies(docs.where("doc_id < 4")).count() == 4
    wide = docs.selectExpr("*", "'x' AS node", "1 AS key", "2 AS component_id", "3 AS kept")
    assert cm.near_copies(wide, 3, 85).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    texts = docs.where("doc_id > 3").selectExpr("concat('d', doc_id) AS doc_id", "text")
    got = {r["doc_id"]: r["component_id"] for r in cm.near_copies(texts, 3, 85).collect()}
    assert got == {"d4": "d4", "d5": "d4", "d6": "d6", "d7": "d6"}


def test_signatures_are_shifted_minima():
    """Each coordinate against both permutations written out; sets across the pieces that are read at a time."""
    draw = np.random.default_rng(1)
    hashes = [np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 5, 3000, 2, 2500)]
    first = np.cumsum([0] + [len(h) for h in hashes])
    got = cm.signatures(np.concatenate(hashes), first, 12)
    order = np.argsort(cm.mix(np.arange(cm.PLACES, dtype=np.uint64) * cm._BAND + cm._SECOND), kind="stable")
    value = np.empty(cm.PLACES, np.int64)
    value[order] = np.arange(cm.PLACES)
    for row, own in zip(got, hashes, strict=True):
        places = (cm.mix(own ^ cm._FIRST) >> np.uint64(64 - cm.PLACE_BITS)).astype(np.int64)
        assert row.tolist() == [value[(places + k) % cm.PLACES].min() for k in range(12)]


def test_coordinates_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(2)
    pool = draw.integers(0, 1 << 63, 1200, dtype=np.uint64)
    sets = [np.sort(pool[:1000]), np.sort(pool[200:])]
    a, b = cm.signatures(np.concatenate(sets), np.array([0, 1000, 2000]), 4096)
    assert abs((a == b).mean() - 800 / 1200) < 0.03


def test_pairs_just_similar_enough_are_candidates(spark):
    """400 pairs of similarity 0.85 to 0.87: all share a band."""
    rows = []
    for i in range(400):
        words = [f"p{i}w{j}" for j in range(100)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: 85 + i % 3]))]
    same(spark, rows, 1, 85)


def test_bands_for():
    for percent in (60, 80, 85, 95):
        bands = cm.bands_for(percent)
        assert (1 - (percent / 100) ** cm.ROWS) ** bands <= cm.MISSED < (1 - (percent / 100) ** cm.ROWS) ** (bands - 1)


def test_hot_buckets_give_few_rows(spark):
    """A bucket of nodes that are no links: what becomes rows are the pairs that the maps leave open."""
    draw = np.random.default_rng(3)
    maps = draw.integers(0, 1 << 62, (2000, cm.BIT_WORDS))
    rows = [(1, i, i, 300, [int(x) for x in maps[i]], 4) for i in range(2000)]
    schema = "key long, node long, component long, n_shingles long, bits array<long>, blocks long"
    df = spark.createDataFrame(rows, schema)
    assert cm._pairs_across(df, 85).count() == 0
    twins = df.where("node < 1000").selectExpr("key", "node + 5000 AS node", "component + 5000 AS component", "n_shingles", "bits", "blocks")
    got = Scratch(spark, "test").keep(cm._pairs_across(df.unionByName(twins), 85), "pairs")
    assert got.count() == got.distinct().count() == got.where("abs(u - v) = 5000").count() == 1000
