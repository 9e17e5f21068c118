from __future__ import annotations

import json

import pytest

from textlake import jobs


def test_people(spark, tmp_path, capsys):
    source = tmp_path / "people.csv"
    source.write_text("id,name,age,city\n1,Ann,30,\n2,Bob,,X\n3,Cy,-1,X\n")
    jobs.main(["people", str(source), str(tmp_path / "out")])
    assert "1 rows kept" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out")).first()["city"] == "Unknown"


def test_sales(spark, tmp_path, capsys):
    source = tmp_path / "sales.csv"
    source.write_text(
        "order_id,order_date,customer,region,category,status,amount,quantity\n"
        "1,2026-01-05,Ann,Asia ,Toys,completed,10.5,2\n"
        "1,2026-01-05,Ann,Asia ,Toys,completed,10.5,2\n"
        "2,2026-02-30,Bob,Asia,Toys,completed,1,1\n"
        "3,2026-01-06,Bob,Europe,TOYS,pending,100,1\n"
    )
    jobs.main(["sales", str(source), str(tmp_path / "out")])
    assert "4 rows read, 2 kept" in capsys.readouterr().out
    (report,) = (tmp_path / "out" / "report.csv").glob("part-*.csv")
    assert report.read_text().splitlines()[1:] == [
        "toys,Europe,1,100.0,100.0,1",
        "toys,Asia,1,21.0,10.5,2",
    ]


def test_news(spark, tmp_path, capsys):
    item = {"source": "BBC", "title": "A win", "link": "l", "published": "p", "summary": "s"}
    (tmp_path / "news_1.json").write_text(json.dumps([item, item, {**item, "title": ""}]))
    jobs.main(["news", str(tmp_path / "news_*.json"), str(tmp_path / "out")])
    out = capsys.readouterr().out
    assert "3 items read, 1 kept" in out
    assert "positive|    1" in out


def feed(path, *titles):
    items = "".join(
        f"<item><title>{t}</title><link>http://x/{t}</link><description>about {t}</description></item>"
        for t in titles
    )
    path.write_text(f"<rss><channel>{items}</channel></rss>")


@pytest.fixture
def paths(tmp_path):
    names = ("landing", "store", "checkpoint", "vectors", "answers")
    return {name: str(tmp_path / name) for name in names}


def test_from_feeds_to_answers(spark, tmp_path, capsys, paths):
    def take_in():
        jobs.main(["land", paths["landing"], f"A={tmp_path / 'a.xml'}"])
        capsys.readouterr()
        jobs.main(
            ["refresh", paths["landing"], paths["store"], paths["checkpoint"],
             "--vectors", paths["vectors"]]
        )
        return capsys.readouterr().out.strip()

    feed(tmp_path / "a.xml", "rockets", "gardens")
    assert take_in() == "NEW_NEWS=2 total=2"
    assert take_in() == "NEW_NEWS=0 total=2"
    feed(tmp_path / "a.xml", "rockets", "rivers")
    assert take_in() == "NEW_NEWS=1 total=3"

    queries = tmp_path / "queries.json"
    queries.write_text(
        '{"query_id": "q1", "query": "rivers about rivers"}\n{"query_id": "q2", "query": "zzz"}\n'
    )
    jobs.main(
        ["ask", str(queries), paths["store"], paths["vectors"], paths["answers"], "--no-model"]
    )
    rows = {r["query_id"]: r for r in spark.read.json(paths["answers"]).collect()}
    assert rows["q1"]["sources"][0]["title"] == "rivers"
    assert rows["q1"]["status"] == "retrieval_only"
    assert rows["q2"]["status"] == "nothing_found"


def test_index(spark, tmp_path, capsys):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.md").write_text("word " * 300)
    table = str(tmp_path / "table")
    jobs.main(["index", str(folder), table])
    first = capsys.readouterr().out
    (folder / "b.md").write_text("short")
    jobs.main(["index", str(folder), table, "--append"])
    assert (first.strip(), capsys.readouterr().out.strip()) == (
        "index: 4 chunks",
        "index: 5 chunks",
    )
