"""Keeping a stored table up to date with newly arrived rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.operators.cleaning import label_news, titled
from textlake.operators.dedupe import keep_first

# Keys up to this size are sent to all executors; above it both sides shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a table, as text, stay below a size. Runs a small job."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns],
    )
    size = df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("size")).first()["size"]
    return size <= limit


def few(df: DataFrame) -> DataFrame:
    """The table, marked to be sent to the other side of a join if it is measured to be small."""
    return F.broadcast(df) if fits_broadcast(df) else df


def _keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(name).alias(f"_{name}") for name in key])


def _same(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])


def not_in(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is not in ``other``; a null key equals a null key."""
    return df.join(_keys(other, key), _same(key), "left_anti")


def new_items(fresh: DataFrame, store: DataFrame, key: Sequence[str] = ("link",)) -> DataFrame:
    """One row for each key of ``fresh`` that the store does not have.

    The store is the large side. When the fresh keys are few enough, they go to
    the store instead: it is scanned for them without a shuffle, and the keys it
    knows are then no more than the fresh ones.
    """
    key = list(key)
    known = store.select(*key)
    wanted = _keys(fresh, key)
    if fits_broadcast(wanted):
        known = known.join(F.broadcast(wanted), _same(key), "left_semi").distinct()
    return not_in(keep_first(fresh, key), known, key)


def merge_items(store: DataFrame, fresh: DataFrame, **words) -> DataFrame:
    """The store with the cleaned and labelled new items added.

    Columns one of the two lacks are null in its rows.
    """
    added = label_news(new_items(titled(fresh), store), **words)
    return store.unionByName(added, allowMissingColumns=True)


def append_new_items(
    fresh: DataFrame, store_path: str, key: Sequence[str] = ("link",), **words
) -> None:
    """Add the new items to the stored table; nothing new writes nothing.

    Rows are only added, never rewritten, so a failed run leaves the table as it
    was and a repeated one adds nothing twice.
    """
    store = fresh.sparkSession.read.parquet(store_path)
    added = label_news(new_items(titled(fresh), store, key), **words).persist()
    try:
        if not added.isEmpty():
            added.select(*store.columns).write.mode("append").parquet(store_path)
    finally:
        added.unpersist()


def refresh_summary(store: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row: ``new_news`` and the ``total`` of stored items afterwards.

    ``new_news`` counts links once and only titled items; ``total`` is what the
    table really holds after the merge.
    """
    added = new_items(titled(fresh), store).agg(F.count("*").alias("new_news"))
    before = store.agg(F.count("*").alias("stored"))
    return (
        added.select("new_news", F.lit(0).cast("bigint").alias("stored"))
        .unionByName(before.select(F.lit(0).cast("bigint").alias("new_news"), "stored"))
        .agg(
            F.sum("new_news").alias("new_news"),
            F.sum(F.col("new_news") + F.col("stored")).alias("total"),
        )
    )
