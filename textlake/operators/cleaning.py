"""Cleaning of people, sales and news tables, and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textlake.functions import fixed_values as fixed
from textlake.functions import text as tx
from textlake.operators.dedupe import keep_first, top_per_group


def age_in_years() -> Column:
    """``age`` as a whole number, its decimals cut off; null where the text is no number."""
    return F.col("age").try_cast("double").try_cast("int")


def older_than(people: DataFrame, years: int) -> DataFrame:
    """Name and age of people above an age; text that is no number does not count."""
    return people.where(age_in_years() > years).select("name", "age")


def clean_people(people: DataFrame) -> DataFrame:
    """Drop people without a valid age; a missing city becomes ``Unknown``."""
    return people.where(age_in_years() >= 0).withColumn(
        "city", F.coalesce("city", F.lit("Unknown"))
    )


def count_per_group(df: DataFrame, *group: str) -> DataFrame:
    """Rows per group, largest first; ties by the group."""
    return df.groupBy(*group).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *group)


def oldest_per_city(people: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` oldest people of each city, by age as a number, ties by id."""
    order = [age_in_years().desc(), F.col("id").try_cast("bigint")]
    return top_per_group(people, ["city"], order, n)


def clean_sales(sales: DataFrame, valid_status: Sequence[str] = fixed.VALID_STATUS) -> DataFrame:
    """Sales with trimmed text, real dates, one row per order and its revenue.

    Of the rows of an order, the first by all its columns stays, before the
    check of its state: an order whose first row is cancelled is left out whole.
    """
    tidy = sales.withColumns(
        {
            "customer": F.trim("customer"),
            "region": F.trim("region"),
            "category": F.lower(F.trim("category")),
            "status": F.trim("status"),
            "order_date": tx.strict_date(F.col("order_date")),
        }
    )
    needed = [F.col(name).isNotNull() for name in ("order_id", "order_date", "amount", "quantity")]
    return (
        keep_first(tidy.where(reduce(Column.__and__, needed)), ["order_id"])
        .where(F.col("status").isin(*valid_status) & (F.col("amount") > 0))
        .withColumn("revenue", F.round(F.col("amount") * F.col("quantity"), 2))
    )


def sales_report(sales: DataFrame) -> DataFrame:
    """Orders, revenue, mean amount and units per category and region.

    Revenue and amounts have two decimals, so they are summed as decimals: neither
    total nor mean depends on the order in which tasks are merged. A mean on a half
    cent is rounded away from zero.
    """
    revenue = F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double")
    amount = F.sum(F.col("amount").cast("decimal(18,2)")) / F.count("amount")
    return (
        sales.groupBy("category", "region")
        .agg(
            F.count("*").alias("order_count"),
            revenue.alias("total_revenue"),
            F.round(amount, 2).cast("double").alias("avg_amount"),
            F.sum("quantity").alias("total_quantity"),
        )
        .orderBy(F.desc("total_revenue"), "category", "region")
    )


def titled(news: DataFrame) -> DataFrame:
    """Items with a title; one of blanks counts as a title."""
    return news.where(F.col("title").isNotNull() & (F.col("title") != ""))


def label_news(
    news: DataFrame,
    positive: Sequence[str] = fixed.POSITIVE_WORDS,
    negative: Sequence[str] = fixed.NEGATIVE_WORDS,
    whole_word: bool = False,
) -> DataFrame:
    """Add the combined text and its sentiment."""
    return news.withColumn(
        "text_combined", tx.combined_text(F.col("title"), F.col("summary"))
    ).withColumn(
        "sentiment", tx.sentiment(F.col("text_combined"), positive, negative, whole_word)
    )


def clean_news(news: DataFrame, **words) -> DataFrame:
    """Titled items, one per link, with combined text and sentiment.

    Items without a title go first, so that one never stands for its link, and
    the filter can reach the scan.
    """
    return label_news(keep_first(titled(news), ["link"]), **words)


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another job reads them, instead of in a job of its own.

    The observation has the number, under ``rows``, once an action has run.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
