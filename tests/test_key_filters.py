"""A batch opens only the files that may hold its keys, and loses none that does."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.operators import key_filters
from textlake.operators.cleaning import label_news
from textlake.operators.key_filters import KeyedStore, bloom, may_hold
from textlake.operators.merge import new_items
from textlake.sources.readers import NEWS


def news(spark, links, title="t"):
    return spark.createDataFrame([("s", title, link, "p", "x") for link in links], NEWS)


@pytest.fixture
def store(spark, tmp_path):
    """Eight commits of fifty links each."""
    made = KeyedStore(spark, str(tmp_path / "a store"))
    for n in range(8):
        made.add(label_news(news(spark, [f"l{n}-{i}" for i in range(50)])).coalesce(1))
    return made


def test_filters_hold_their_keys():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        bits = bloom(keys)
        assert may_hold(bits, keys).all()
        assert len(bits) * 8 <= max(key_filters.LEAST_BITS, 2 * key_filters.KEY_BITS * n)
        others = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
        assert may_hold(bits, others).mean() < 1e-5


def test_few_files_are_opened(spark, store):
    new = news(spark, [f"new{i}" for i in range(300)])
    assert store.files_for(new) == []
    some = news(spark, ["l3-7", "l3-8", "l6-0", "new"])
    assert len(store.files_for(some)) == 2
    assert len(store.may_know(some).inputFiles()) == 2
    assert [r["link"] for r in store.new_items(some).collect()] == ["new"]
    assert len(store.files_for(news(spark, [f"l{n}-1" for n in range(8)]))) == 8


def test_as_the_whole_store(spark, store):
    fresh = news(spark, [f"l{n}-{i}" for n in range(10) for i in range(0, 60, 7)] + ["l0-1", "x", "x", None, ""])
    got = store.new_items(fresh)
    wanted = new_items(fresh, store.rows.read())
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_too_many_keys_read_the_store(spark, store, monkeypatch):
    monkeypatch.setattr(key_filters, "fits_broadcast", lambda df: False)
    fresh = news(spark, ["l1-1", "y"])
    assert store.files_for(fresh) is None
    assert [r["link"] for r in store.new_items(fresh).collect()] == ["y"]


def test_append_twice_and_null_keys(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    fresh = news(spark, ["a", "a", None, None, "b"])
    store.append_new(fresh)
    store.append_new(fresh)
    store.append_new(news(spark, ["b", "c"]).union(news(spark, ["d"], "")))
    assert sorted(str(r["link"]) for r in store.rows.read().collect()) == ["None", "a", "b", "c"]
    assert store.rows.numbers() == [1, 2]


def test_a_writer_that_dies_between_its_commits(spark, store, monkeypatch):
    """Filters are there, rows are not: the next writer starts from what the rows name."""
    before = store.rows.version()
    commit = store.rows.commit
    monkeypatch.setattr(store.rows, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.append_new(news(spark, ["lost", "l1-1"]))
    monkeypatch.setattr(store.rows, "commit", commit)
    assert store.rows.version() == before
    assert store.files_for(news(spark, ["lost"])) == []
    store.append_new(news(spark, ["lost", "l1-1", "l9"]))
    assert store.rows.read().where(F.col("link").isin("lost", "l9")).count() == 2
    assert len(store.files_for(news(spark, ["lost", "l2-2"]))) == 2
    assert store.new_items(news(spark, ["lost", "l1-1", "l9"])).count() == 0
