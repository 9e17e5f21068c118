"""What the plans must and must not hold, whatever the size of the data."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from textlake import plans
from textlake.operators import merge, sessions
from textlake.operators.cleaning import clean_news, clean_sales, oldest_per_city, titled
from textlake.operators.dedupe import keep_first
from textlake.plans.chat import messages, toxic_ids
from textlake.plans.news import news, store
from textlake.plans.people import people
from textlake.sources.readers import SALES


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", plans.queries())
def test_no_row_wise_python_and_no_product(spark, name):
    text = plan(plans.queries()[name](spark, SMALL))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_groups_are_cut_before_the_shuffle(spark):
    for df in (
        oldest_per_city(people(spark, SMALL)),
        keep_first(news(spark, SMALL), ["link"]),
        plans.queries()["vector_topk"](spark, SMALL),
    ):
        text = plan(df)
        tree = text[: text.index("(1)")]
        assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex(
            "WindowGroupLimit"
        )


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.createDataFrame([], SALES).write.parquet(path)
    text = plan(clean_sales(spark.read.parquet(path)))
    for name in ("order_id", "amount", "quantity"):
        assert f"IsNotNull({name})" in text


def test_title_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "news")
    news(spark, SMALL).write.parquet(path)
    text = plan(clean_news(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(title), Not(EqualTo(title,))]" in text


def test_combined_text_is_worked_out_once(spark, tmp_path):
    path = str(tmp_path / "news")
    news(spark, SMALL).write.parquet(path)
    text = plan(clean_news(spark.read.parquet(path)))
    assert text.count("lower(concat_ws(") == 1


def test_the_store_is_scanned_for_few_new_keys_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "store")
    store(spark, SMALL).write.parquet(path)
    fresh = titled(news(spark, SMALL))
    text = plan(merge.new_items(fresh, spark.read.parquet(path)))
    assert "BroadcastHashJoin LeftSemi" in text
    assert "LeftAnti" in text


def test_only_the_key_of_the_store_is_read(spark, tmp_path):
    path = str(tmp_path / "store")
    store(spark, SMALL).write.parquet(path)
    text = plan(merge.new_items(news(spark, SMALL), spark.read.parquet(path)))
    assert "ReadSchema: struct<link:string>" in text


def test_sessions_are_dropped_by_an_anti_join(spark):
    assert "LeftAnti" in plan(sessions.drop_sessions(messages(spark, SMALL), toxic_ids(spark, SMALL)))


def test_a_hot_conversation_is_spread_over_its_parts(spark):
    hot = spark.range(0, 50_000).select(
        F.lit(1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.lit("x").alias("text"),
    )
    parts = sessions.history_parts(hot, 1000)
    assert parts.count() == 50
    assert parts.agg(F.max(F.length("history"))).first()[0] < 20_000
