from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textlake.operators import cleaning
from textlake.operators.dedupe import keep_first
from textlake.sources.readers import NEWS, PEOPLE, SALES

ROWS = [
    ("1", "Alice", "30", "Singapore"),
    ("2", "Bob", "25", "Kuala Lumpur"),
    ("3", "Charlie", "35", "Singapore"),
    ("4", "David", "28", "Jakarta"),
    ("5", "Eve", "32", "Singapore"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, PEOPLE)


def test_older_than(people):
    assert {tuple(r) for r in cleaning.older_than(people, 28).collect()} == {
        ("Alice", "30"),
        ("Charlie", "35"),
        ("Eve", "32"),
    }


def test_ages_compare_as_numbers(spark):
    people = spark.createDataFrame(
        [("1", "a", "9", "X"), ("2", "b", "35", "X"), ("3", "c", "old", "X")], PEOPLE
    )
    assert [r["name"] for r in cleaning.older_than(people, 8).orderBy("name").collect()] == [
        "a",
        "b",
    ]
    first = cleaning.oldest_per_city(people, 1).collect()
    assert [r["name"] for r in first] == ["b"]


def test_count_per_group(people):
    got = [tuple(r) for r in cleaning.count_per_group(people, "city").collect()]
    assert got == [("Singapore", 3), ("Jakarta", 1), ("Kuala Lumpur", 1)]


def test_oldest_per_city(people):
    got = {(r["city"], r["rank"], r["name"]) for r in cleaning.oldest_per_city(people).collect()}
    assert got == {
        ("Singapore", 1, "Charlie"),
        ("Singapore", 2, "Eve"),
        ("Kuala Lumpur", 1, "Bob"),
        ("Jakarta", 1, "David"),
    }


def test_sql_over_a_view(spark, people):
    people.createOrReplaceTempView("people_fixture")
    got = spark.sql(
        "SELECT name, age FROM people_fixture WHERE city = 'Singapore' ORDER BY age DESC"
    ).collect()
    assert [tuple(r) for r in got] == [("Charlie", "35"), ("Eve", "32"), ("Alice", "30")]


def test_clean_people(spark):
    dirty = spark.createDataFrame(
        [
            ("1", "Alice", "30", "Singapore"),
            ("2", "Bob", None, "Kuala Lumpur"),
            ("3", "Charlie", "35", None),
            ("4", "David", "-10", "Jakarta"),
            ("5", "Eve", "32", "Singapore"),
            ("6", "Frank", "28", "Singapore"),
        ],
        PEOPLE,
    )
    got = cleaning.clean_people(dirty).orderBy("id").collect()
    assert [(r["id"], r["city"]) for r in got] == [
        ("1", "Singapore"),
        ("3", "Unknown"),
        ("5", "Singapore"),
        ("6", "Singapore"),
    ]


@pytest.fixture(scope="module")
def sales(spark):
    ok = (1, "2026-01-05", " Ann ", "Singapore ", "Electronics", "completed", 10.5, 2)
    rows = [
        ok,
        (2, "2026-01-06", "Bob", "Singapore", " ELECTRONICS", " pending", 3.333, 3),
        (3, "2026-02-30", "Bob", "Asia", "Toys", "completed", 1.0, 1),
        (4, "2026-01-07", "Bob", "Asia", "Toys", "completed", None, 1),
        (5, "2026-01-07", "Bob", "Asia", "Toys", "completed", 1.0, None),
        (None, "2026-01-07", "Bob", "Asia", "Toys", "completed", 1.0, 1),
        (6, "2026-01-07", "Bob", "Asia", "Toys", "cancelled", 1.0, 1),
        (7, "2026-01-07", "Bob", "Asia", "Toys", "Completed", 1.0, 1),
        (8, "2026-01-07", "Bob", "Asia", "Toys", None, 1.0, 1),
        (9, "2026-01-07", "Bob", "Asia", "Toys", "completed", 0.0, 1),
        (10, "2026-01-07", "Bob", "Asia", "Toys", "completed", -5.0, 1),
        ok,
        # The first row of order 11 is cancelled, so the order goes.
        (11, "2026-01-01", "Bob", "Asia", "Toys", "cancelled", 1.0, 1),
        (11, "2026-01-02", "Bob", "Asia", "Toys", "completed", 1.0, 1),
        (12, "2026-01-08", "Cy", "Asia", "toys", "completed", 2.0, 4),
    ]
    return spark.createDataFrame(rows, SALES)


def test_clean_sales(sales):
    got = cleaning.clean_sales(sales).orderBy("order_id").collect()
    assert [(r["order_id"], r["category"], r["region"], r["customer"], r["revenue"]) for r in got] == [
        (1, "electronics", "Singapore", "Ann", 21.0),
        (2, "electronics", "Singapore", "Bob", 10.0),
        (12, "toys", "Asia", "Cy", 8.0),
    ]
    assert dict(cleaning.clean_sales(sales).dtypes)["order_date"] == "date"


def test_sales_report(sales):
    got = [tuple(r) for r in cleaning.sales_report(cleaning.clean_sales(sales)).collect()]
    assert got == [
        ("electronics", "Singapore", 2, 31.0, 6.92, 5),
        ("toys", "Asia", 1, 8.0, 2.0, 4),
    ]


def test_rows_are_counted_on_the_way(spark, sales, tmp_path):
    raw, seen = cleaning.count_rows(sales, "test raw")
    cleaned, kept = cleaning.count_rows(cleaning.clean_sales(raw), "test cleaned")
    cleaned.write.parquet(str(tmp_path / "out"))
    assert (seen.get["rows"], kept.get["rows"]) == (15, 3)


@pytest.fixture(scope="module")
def news(spark):
    return spark.createDataFrame(
        [
            ("BBC", "A great win", "l1", "p1", "More"),
            ("BBC", "A great win", "l1", "p1", "More"),
            ("BBC", "", "l2", "p1", "No title"),
            ("CNN", "Bad luck", "l2", "p2", None),
            ("CNN", None, "l3", "p2", "No title"),
            ("CNN", " ", "l4", "p2", "Blank title"),
        ],
        NEWS,
    )


def test_clean_news_filters_before_it_dedupes(news):
    got = cleaning.clean_news(news).orderBy("link").collect()
    assert [(r["link"], r["text_combined"], r["sentiment"]) for r in got] == [
        ("l1", "a great win more", "positive"),
        ("l2", "bad luck", "negative"),
        ("l4", "  blank title", "neutral"),
    ]


def test_keep_first_is_the_same_in_any_layout(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 7).alias("k"), F.hash("id").alias("a"), F.col("id").alias("b")
    )
    wanted = {tuple(r) for r in keep_first(df, ["k"]).collect()}
    assert len(wanted) == 7
    for n in (1, 13):
        assert {tuple(r) for r in keep_first(df.repartition(n), ["k"]).collect()} == wanted


def test_mean_on_a_half_cent(spark):
    """100.005 as a mean of doubles falls to either side; as decimals it is 100.01."""
    rows = [(i, "toy", "ASIA", 100.0 + (i % 2) / 100, 1, 1.0) for i in range(2000)]
    sales = spark.createDataFrame(
        rows, "order_id bigint, category string, region string, amount double, quantity int, revenue double"
    )
    for parts in (1, 7):
        found = cleaning.sales_report(sales.repartition(parts)).first()
        assert (found["avg_amount"], found["total_revenue"]) == (100.01, 2000.0)
