"""Readers, writers, the vector table and the refresh stream."""

from __future__ import annotations

import json

import pytest
import numpy as np
from pyspark.sql import Observation
from pyspark.sql import functions as F

from textlake import session
from textlake.operators.vector_table import (
    append_vectors,
    rebuild_vector_table,
    update_vectors,
    vector_rows,
)
from textlake.sources import readers, writers
from textlake.streaming.refresh import start_refresh

ITEM = {"source": "BBC", "title": "T", "link": "l", "published": "p", "summary": "é"}


def test_csv_strings_and_inferred(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,name,age,city\n1,Ann,,\n2,Bob,31,X\n")
    strings = readers.read_csv(spark, str(path))
    assert {kind for _, kind in strings.dtypes} == {"string"}
    assert tuple(strings.orderBy("id").first()) == ("1", "Ann", None, None)
    assert dict(readers.read_csv(spark, str(path), infer=True).dtypes)["age"] == "int"
    assert readers.read_csv(spark, str(path), readers.PEOPLE).count() == 2


def test_json_arrays_over_a_glob(spark, tmp_path):
    for day in (1, 2):
        items = [{**ITEM, "link": f"l{day}"}, {"title": "part", "link": f"m{day}"}]
        (tmp_path / f"news_{day}.json").write_text(json.dumps(items, indent=2))
    news = readers.read_json_arrays(spark, str(tmp_path / "*.json"))
    assert news.columns == readers.NEWS.names
    assert sorted(r["link"] for r in news.collect()) == ["l1", "l2", "m1", "m2"]
    assert news.where("source IS NULL").count() == 2


FEED = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title>A &amp; B</title><link>http://x/1</link><pubDate>Fri, 11 Sep 2026 GMT</pubDate>
<description><![CDATA[<p>One</p><p>two &copy;</p>]]></description></item>
<item><title>No more</title></item></channel></rss>"""


def test_feeds(spark, tmp_path):
    (tmp_path / "a.xml").write_text(FEED)
    (tmp_path / "broken.xml").write_text("<rss><channel><item><title>x")
    feeds = {
        "A": str(tmp_path / "a.xml"),
        "Broken": str(tmp_path / "broken.xml"),
        "Missing": str(tmp_path / "none.xml"),
    }
    got = [tuple(r) for r in readers.read_feeds(spark, feeds).collect() if r["source"] == "A"]
    assert got == [
        ("A", "A & B", "http://x/1", "Fri, 11 Sep 2026 GMT", "Onetwo ©"),
        ("A", "No more", "", "", ""),
    ]
    with pytest.raises(RuntimeError):
        readers.read_feeds(spark, {"Missing": str(tmp_path / "none.xml")})


def test_document_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("line 1\nline 2\n")
    (tmp_path / "sub" / "b.md").write_text("b")
    (tmp_path / "c.txt").write_text("not wanted")
    got = {
        r["doc_id"].rsplit("/", 1)[1]: r["text"]
        for r in readers.read_documents(spark, str(tmp_path)).collect()
    }
    assert got == {"a.md": "line 1\nline 2\n", "b.md": "b"}


def test_range_and_records(spark):
    assert [r["id"] for r in readers.integers(spark, 1, 6).collect()] == [1, 2, 3, 4, 5]
    got = readers.from_records(spark, [ITEM, {"title": "only"}]).collect()
    assert tuple(got[1]) == (None, "only", None, None, None)


def test_csv_report_is_one_file_in_order(spark, tmp_path):
    report = spark.range(0, 1000, 1, 4).orderBy(F.desc("id"))
    path = tmp_path / "report"
    writers.write_csv_report(report, str(path))
    (file,) = path.glob("part-*.csv")
    assert [int(x) for x in file.read_text().split()[1:]] == list(range(999, -1, -1))
    writers.write_csv_report(spark.range(0, 1000, 1, 4), str(path), single_file=False)
    assert len(list(path.glob("part-*.csv"))) > 1


def test_landing_and_round_trip(spark, tmp_path):
    items = readers.from_records(spark, [ITEM])
    other = readers.from_records(spark, [{**ITEM, "source": "other"}])
    for landed in (items, other, items):
        writers.land_json(landed, str(tmp_path / "landing"), "2026-09-12")
    assert len(list((tmp_path / "landing").rglob("part-*.json"))) == 2
    feed = tmp_path / "landing" / "ingest_date=2026-09-12" / f"feed={ITEM['source']}"
    (file,) = feed.glob("*.json")
    assert json.loads(file.read_text()) == ITEM
    assert "é" in file.read_text()
    assert writers.round_trip(items, str(tmp_path / "table")).collect() == items.collect()


def test_object_store_settings(monkeypatch):
    monkeypatch.setenv("S3_ENDPOINT", "http://store:9000")
    monkeypatch.delenv("AWS_ACCESS_KEY_ID", raising=False)
    settings = session.object_store_settings(secret_key="s")
    assert settings == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.secret.key": "s",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def test_work_paths_are_fresh_and_shared(spark):
    a, b = session.work_path(spark, "x"), session.work_path(spark, "x")
    assert a != b
    assert a.startswith(session.shared_folder(spark))


def test_vector_table(spark, tmp_path):
    path = str(tmp_path / "vectors")
    docs = spark.createDataFrame(
        [("a", "one two three " * 60), ("b", "short")], "doc_id string, text string"
    )
    rebuild_vector_table(vector_rows(docs.where("doc_id = 'b'")), path)
    for _ in range(2):
        append_vectors(vector_rows(docs.unionByName(docs)), path)
    table = spark.read.parquet(path)
    wanted = vector_rows(docs)
    assert table.count() == wanted.count() == 3
    assert sorted(r["id"] for r in table.collect()) == ["a#0", "a#1", "b#0"]
    rebuild_vector_table(vector_rows(docs.where("doc_id = 'b'")), path)
    assert spark.read.parquet(path).count() == 1


def test_update_embeds_only_what_changed(spark, tmp_path):
    path, log = str(tmp_path / "vectors"), str(tmp_path / "log")

    def load():
        def encode(texts):
            with open(log, "a") as file:
                file.writelines(f"{t[:5]}\n" for t in texts)
            return np.ones((len(texts), 3))

        return encode

    def run(**texts):
        docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
        open(log, "w").close()
        update_vectors(docs, path, 500, 50, load)
        rows = spark.read.parquet(path).collect()
        return sorted((r["id"], r["text"][:5]) for r in rows), sorted(set(open(log).read().split()))

    long = "aaaaa " * 150
    assert run(a=long, b="bbbbb") == ([("a#0", "aaaaa"), ("a#1", "aaaaa"), ("b#0", "bbbbb")], ["aaaaa", "bbbbb"])
    assert run(a=long, b="bbbbb")[1] == []
    got, embedded = run(a="new a", b="b" * 9 + " bb" * 400, c="ccccc")
    assert [g for g in got if g[0][0] != "b"] == [("a#0", "new a"), ("c#0", "ccccc")]
    assert len([g for g in got if g[0][0] == "b"]) > 1 and "aaaaa" not in embedded
    assert len(run(b="bbbbb")[0]) == 3


def test_update_embeds_each_chunk_once(spark, tmp_path):
    path, log = str(tmp_path / "vectors"), str(tmp_path / "log")

    def load():
        def encode(texts):
            with open(log, "a") as file:
                file.writelines(f"{t}\n" for t in texts)
            return np.ones((len(texts), 3))

        return encode

    def run(rows):
        open(log, "w").close()
        update_vectors(spark.createDataFrame(rows, "doc_id string, text string"), path, 500, 50, load)
        return sorted(open(log).read().splitlines())

    run([("same", "same"), ("old", "old")])
    assert run([("same", "same"), ("old", "changed"), ("new", "new"), (None, "lost")]) == ["changed", "lost", "new"]
    rows = sorted((r["id"], r["text"]) for r in spark.read.parquet(path).collect())
    assert rows == [("0", "lost"), ("new#0", "new"), ("old#0", "changed"), ("same#0", "same")]


def land(spark, path, day, *links):
    items = [{**ITEM, "link": link, "title": "" if link == "blank" else "a win"} for link in links]
    writers.land_json(readers.from_records(spark, items), path, day)


def test_refresh(spark, tmp_path):
    landing, store, vectors, checkpoint = (
        str(tmp_path / name) for name in ("landing", "store", "vectors", "checkpoint")
    )

    def run():
        start_refresh(spark, landing, store, checkpoint, vectors).awaitTermination()
        return (
            sorted(r["link"] for r in spark.read.parquet(store).collect()),
            sorted(r["doc_id"] for r in spark.read.parquet(vectors).collect()),
        )

    land(spark, landing, "2026-09-11", "a", "a", "b", "blank")
    assert run() == (["a", "b"], ["a", "b"])
    assert run() == (["a", "b"], ["a", "b"])
    land(spark, landing, "2026-09-12", "b", "c")
    assert run() == (["a", "b", "c"], ["a", "b", "c"])
    assert {r["sentiment"] for r in spark.read.parquet(store).collect()} == {"positive"}
    # A lost checkpoint reads everything again and still adds nothing twice.
    checkpoint = str(tmp_path / "other")
    assert run() == (["a", "b", "c"], ["a", "b", "c"])


def test_a_batch_that_failed_half_way_is_completed(spark, tmp_path, monkeypatch):
    from textlake.streaming import refresh

    landing, store, vectors, checkpoint = (
        str(tmp_path / name) for name in ("landing", "store", "vectors", "checkpoint")
    )
    land(spark, landing, "2026-09-11", "a", "b")

    def fail(*_args, **_kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "write_parquet", fail)
        with pytest.raises(Exception, match="lost"):
            start_refresh(spark, landing, store, checkpoint, vectors).awaitTermination()
    assert spark.read.parquet(vectors).count() == 2
    assert spark.read.parquet(store).count() == 0
    start_refresh(spark, landing, store, checkpoint, vectors).awaitTermination()
    assert spark.read.parquet(vectors).count() == 2
    assert spark.read.parquet(store).count() == 2


def outcomes(df):
    rows = [(r["source"], r["file"].rsplit("/", 1)[-1], r["items"], r["broken"], r["state"]) for r in df.collect()]
    return sorted(rows)


def test_feed_outcomes(spark, tmp_path):
    item = "<item><title>{}</title><link>l</link></item>"
    folder = tmp_path / "feed a+b"
    folder.mkdir()
    (folder / "good one.xml").write_text(f"<rss><channel>{item.format('a')}{item.format('b')}</channel></rss>")
    (folder / "50%.xml").write_text(f"<rss><channel>{item.format('c')}</channel></rss>")
    (folder / "text.xml").write_text("no feed at all")
    (folder / "none.xml").write_text("<rss><channel></channel></rss>")
    (folder / "zero.xml").write_text("")  # not listed by Spark
    feeds = {"f": str(folder), "gone": str(tmp_path / "gone")}
    assert outcomes(readers.feed_outcomes(spark, feeds)) == [
        ("f", "50%.xml", 1, 0, "read"),
        ("f", "good one.xml", 2, 0, "read"),
        ("f", "none.xml", 0, 0, "empty"),
        ("f", "text.xml", 0, 1, "broken"),
        ("gone", "gone", 0, 0, "missing"),
    ]
    assert readers.feed_outcomes(spark, {}).count() == 0
    seen = Observation("broken items")
    assert readers.read_feeds(spark, feeds, seen).count() == 3
    assert seen.get["items"] == 1
    with pytest.raises(RuntimeError):
        readers.read_feeds(spark, {"text": str(folder / "text.xml"), "gone": feeds["gone"]})


def test_json_array_outcomes(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"link": "1"}, {"link": "2"}]')
    (tmp_path / "b.json").write_text('[{"link": "3"}, {"link"')
    (tmp_path / "c.json").write_text("[]")
    assert outcomes(readers.json_array_outcomes(spark, f"{tmp_path}/*.json"))[0][1:] == ("a.json", 2, 0, "read")
    states = {f: (n, b, s) for _, f, n, b, s in outcomes(readers.json_array_outcomes(spark, f"{tmp_path}/*.json"))}
    assert states == {"a.json": (2, 0, "read"), "b.json": (0, 1, "broken"), "c.json": (0, 0, "empty")}
    assert outcomes(readers.json_array_outcomes(spark, f"{tmp_path}/none"))[0][-1] == "missing"


def test_documents_are_files_in_few_tasks(spark, tmp_path):
    rows = [("en", f"text {n}") for n in range(2100)]
    rows += [("en", "a\nb\n"), ("en", ""), ("en", None), (None, "é"), ("", "x"), ("zh-CN", "新"), ("a/b", "y"), ("..", "z")]
    documents = spark.createDataFrame(rows, "lang string, text string").repartition(3, "text")
    assert writers.write_documents(documents, str(tmp_path / "texts"), "lang") == len(rows)
    read = readers.read_documents(spark, str(tmp_path / "texts"), "*.txt").collect()
    assert sorted(r["text"] for r in read) == sorted((text or "") + "\n" for _, text in rows)
    english = [r for r in read if "/lang=en/" in r["doc_id"]]
    assert len(english) == 2103 and len({r["doc_id"] for r in read}) == len(rows)
    assert not list((tmp_path / "texts").rglob("_temporary"))


def test_the_folder_scan_reads_many_small_files_in_a_task(spark, tmp_path):
    from textlake.plans.files import document_dir_scan

    rows = [(n, "en", f"text {n}") for n in range(600)]
    spark.createDataFrame(rows, "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = document_dir_scan(spark, str(tmp_path))
    # 32 files to a task would make 19 of them.
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, found.collect())) == sorted((lang, f"{text}\n") for _, lang, text in rows)
