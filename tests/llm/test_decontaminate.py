"""Test items in documents and licence notices against exact containment."""

from __future__ import annotations

import random

import duckdb
import pytest
from compare import connect, duck_rows, spark_rows
from test_jaccard_join import shingle_set

from textlake.llm import decontaminate, licenses, registry


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_same_as_sql(spark, folder, name):
    columns, got = spark_rows(registry.queries()[name](spark, folder))
    wanted_columns, wanted = duck_rows(connect(folder), registry.oracle_sql()[name])
    assert columns == wanted_columns and got == wanted and got


def sets(text):
    return {s for s in shingle_set(text, 5) if len(s) == 5}


def shared_with(item, text):
    """Shingles of an item, and how many of them a text holds; a short item is one shingle."""
    own = shingle_set(item, 5)
    short = {len(s) for s in own} - {5}
    return len(own), len(own & set().union(sets(text), *({s for s in shingle_set(text, k) if len(s) == k} for k in short)))


def test_items_of_all_sizes(spark):
    draw = random.Random(2)

    def prose(n):
        return [f"v{draw.randint(0, 3000)}" for _ in range(n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate([3, 5, 6, 9, 14, 20, 33, 64, 100, 300, 40, 40, 1, 2, 4])]
    items += [(100, None), (101, ""), (11, items[11][1]), (102, items[13][1])]
    docs = []
    for i in range(120):
        words = prose(draw.choice([0, 4, 30, 500, 4000]))
        if i % 3:
            own = (draw.choice(items[:15])[1]).split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                own[draw.randrange(len(own))] = "changed"
            at = draw.randint(0, len(words))
            words[at:at] = own
        docs.append((i, " ".join(words)))
    docs += [(500, None), (7, docs[7][1]), (None, docs[8][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS n_item")
    wanted = []
    for doc, text in docs:
        for item, own in {k: t for k, t in items if t}.items():
            n, shared = shared_with(own, text)
            if 10 * shared >= 8 * n:
                wanted.append((doc, item, n, shared))
    got = [tuple(r)[:4] for r in decontaminate.find_items(frame, benchmark).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    kept = decontaminate.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    whole = decontaminate.drop_contaminated(frame, benchmark, least_words=1)
    short = {i for i, t in items if t and len(t.split()) < 5}
    assert {w[1] for w in wanted} >= short
    for frame_kept, bad in ((kept, [w[0] for w in wanted if w[1] not in short]), (whole, [w[0] for w in wanted])):
        left = sorted((d for d, _ in docs if d not in bad), key=repr)
        assert sorted((r.doc_id for r in frame_kept.collect()), key=repr) == left
    assert decontaminate.find_items(frame.limit(0), benchmark).count() == 0
    assert decontaminate.find_items(frame, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(frame, benchmark.limit(0)).count() == len(docs)


def test_ids_that_are_texts_and_items_of_few_words(spark, folder, tmp_path):
    docs = [("a", "Say Hello  world again and again"), ("b", "hello, world"), (None, "hello world"), ("d", None)]
    items = [("x", "hello world"), (None, "WORLD"), ("y", "hello"), ("x", "hello world"), ("z", " ")]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = [tuple(r) for r in decontaminate.find_items(frame, benchmark).collect()]
    hits = [(d, i) for d in ("a", None) for i in ("x", None, "y")] + [("b", None)]
    assert sorted(got, key=repr) == sorted(((d, i, 1, 1, 1.0) for d, i in hits), key=repr)
    # The SQL of the query, for items with an id.
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    named = benchmark.where("item_id IS NOT NULL")
    named.write.parquet(f"{tmp_path}/benchmark.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    columns, got = spark_rows(decontaminate.find_items(frame, named))
    assert (columns, got) == duck_rows(connection, registry.oracle_sql()["op8_decontaminate"]) and got


def test_band_numbers():
    assert decontaminate.bands_for(0.8, 1e-6) == licenses.bands_for(0.8, 1e-6) == 66


def test_notices_in_odd_rows(spark):
    notice = licenses.NOTICES[3][1]
    changed = notice.replace("merge", "fold")
    filler = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, f"{filler} {notice} {filler}"), (4, changed.upper()), (5, "the mit license")]
    rows += [(6, "released under THE\nmit license!"), (6, "released under THE\nmit license!"), (None, notice)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS license", "1 AS `row`")
    templates = licenses.default_templates(spark)
    got = [(r.doc_id, r.template_id) for r in licenses.scan_licenses(docs, templates).collect()]
    assert sorted(got, key=repr) == sorted([(3, 3), (4, 3), (6, 2), (6, 2), (None, 3)], key=repr)
    assert licenses.scan_licenses(docs.limit(0), templates).count() == 0
    assert licenses.scan_licenses(docs, templates.limit(0)).count() == 0
