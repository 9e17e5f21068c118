"""The refresh that remembers links: each once, in one commit, without a look at the store."""

from __future__ import annotations

import json
import logging
from collections import Counter

import pytest

from textlake import jobs
from textlake.operators.cleaning import clean_news
from textlake.sources.readers import NEWS
from textlake.sources.versions import VersionedTable, read_table
from textlake.streaming import seen_links
from textlake.streaming.seen_links import commit_batch, start_seen_refresh, stored_counts


@pytest.fixture(autouse=True)
def quiet():
    logging.disable(logging.INFO)
    yield
    logging.disable(logging.NOTSET)


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


class World:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.table = VersionedTable(spark, str(folder / "store"))
        self.landed = folder / "landing"
        self.landed.mkdir()
        self.items: list[dict] = []

    def land(self, name, *items, broken=0):
        self.items += items
        lines = [json.dumps(i) for i in items] + ["{broken"] * broken
        (self.landed / name).write_text("\n".join(lines))

    def run(self, **options):
        query = start_seen_refresh(
            self.spark, str(self.landed), self.table, str(self.folder / "checkpoint"), **options
        )
        query.awaitTermination()
        return query

    def stored(self):
        return Counter((r["link"], r["title"]) for r in self.table.read().collect())

    def wanted(self):
        rows = [tuple(i.get(n) for n in NEWS.names) for i in self.items]
        cleaned = clean_news(self.spark.createDataFrame(rows, NEWS))
        return Counter((r["link"], r["title"]) for r in cleaned.collect())


def item(link, title="t", source="s", **more):
    return {"link": link, "title": title, "source": source, "summary": "good" if link == "a" else "x", **more}


def test_each_link_once(world, monkeypatch):
    """Within a file, over files, in a late one and in one that landed twice; the store is never read."""
    monkeypatch.setattr(VersionedTable, "read", lambda *a, **k: pytest.fail("the store was read"))
    world.land("1", item("a", "later"), item("a", "first"), item("b", None), item("b"), item(None, "none"), item("", "empty"))
    world.run()
    world.land("2", *[item("c")] * 500, item("b", "other"), item("a", "aaa"))
    world.land("3", item("d", ""), item("e"), broken=2)
    query = world.run()
    seen = [p["observedMetrics"]["parsed"] for p in query.recentProgress if "parsed" in (p["observedMetrics"] or {})]
    assert sum(s["lost"] for s in seen) == 2
    world.land("4", item("e"), item("a", "0"))
    world.run()
    world.run()
    monkeypatch.undo()
    assert world.stored() == Counter({
        ("a", "first"): 1, ("b", "t"): 1, (None, "none"): 1, ("", "empty"): 1, ("c", "t"): 1, ("e", "t"): 1,
    })


def test_first_is_what_keep_first_keeps(world):
    """Nulls first, then by the bytes of all other columns."""
    values = [None, "", "a", "ä", "Z", "\U0001f600", "￿"]
    world.land("1", *[item("x", t, s) for t in ("b", "a") for s in reversed(values)])
    world.land("2", *[item(f"y{i}", "t", v, summary=w) for i, v in enumerate(values) for w in values])
    world.run(files_per_batch=10)
    assert world.stored() == world.wanted()
    rows = {tuple(r) for r in world.table.read().select(*NEWS.names).collect()}
    all_rows = [tuple(i.get(n) for n in NEWS.names) for i in world.items]
    assert rows == {tuple(r) for r in clean_news(world.spark.createDataFrame(all_rows, NEWS)).select(*NEWS.names).collect()}


def test_a_batch_that_is_repeated_adds_nothing(world, monkeypatch):
    """The run dies after the commit and before Spark knows: the batch comes again with its number."""
    world.land("1", item("a"), item("b"))
    commit, calls = seen_links.commit_batch, []

    def dies(*arguments, **words):
        calls.append(commit(*arguments, **words))
        if len(calls) == 1:
            raise RuntimeError("lost")
        return calls[-1]

    monkeypatch.setattr(seen_links, "commit_batch", dies)
    with pytest.raises(Exception, match="lost"):
        world.run()
    world.run()
    assert calls == [True, False]
    assert world.stored() == Counter({("a", "t"): 1, ("b", "t"): 1})
    assert world.table.numbers() == [1]


def test_counts_follow_the_commits(world):
    world.land("1", item("a"), item("b", source="q"))
    world.run()
    first = world.table.version()
    world.land("2", item("c", source="q"), item("d", source="q"), item("a"))
    world.run()
    counts = lambda *g: {r[0]: r["count"] for r in stored_counts(world.table, *g).collect()}
    stored = world.table.read()
    assert counts("source") == {r["source"]: r["count"] for r in stored.groupBy("source").count().collect()} == {"s": 1, "q": 3}
    assert counts("sentiment") == {r["sentiment"]: r["count"] for r in stored.groupBy("sentiment").count().collect()}
    assert {r["source"]: r["n"] for r in world.table.side("counts", first).collect()} == {"s": 1, "q": 1}


def test_forgotten_versions_keep_the_counts(world):
    for n in range(3):
        world.land(str(n), item(f"l{n}"))
        world.run()
    world.table.forget(1)
    assert stored_counts(world.table).first()["count"] == world.table.read().count() == 3


def test_nothing_lands(world):
    world.run()
    world.land("1", broken=3)
    world.run()
    assert world.table.version() is None or world.table.read().count() == 0
    with pytest.raises(ValueError):
        stored_counts(VersionedTable(world.spark, str(world.folder / "none")))


def test_links_can_be_forgotten(world):
    world.land("1", item("a"), item("b"))
    world.run(forget_ms=24 * 3600 * 1000)
    world.land("2", item("a"), item("c"))
    world.run(forget_ms=24 * 3600 * 1000)
    assert sorted(k[0] for k in world.stored()) == ["a", "b", "c"]


def test_a_batch_of_no_rows_is_a_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert commit_batch(table, spark.createDataFrame([], NEWS), 0)
    assert not commit_batch(table, spark.createDataFrame([], NEWS), 0)
    assert stored_counts(table, "source").count() == 0


def test_refresh_job_with_versions(world, capsys):
    world.land("1", item("a"), item("b"))
    arguments = (world.spark, str(world.landed), world.table.root, str(world.folder / "checkpoint"))
    jobs.refresh(*arguments, versions=True)
    world.land("2", item("c"), item("a"))
    jobs.refresh(*arguments, versions=True)
    assert [x for x in capsys.readouterr().out.split("\n") if x] == ["NEW_NEWS=2 total=2", "NEW_NEWS=1 total=3"]
    assert read_table(world.spark, world.table.root).count() == 3
