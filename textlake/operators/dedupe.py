"""De-duplication and top-N per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group with their number in column ``rank``.

    Spark keeps only ``n`` rows of a group in each task before it shuffles
    (``WindowGroupLimit``), so a group holding much of the data costs one task
    no more than ``n`` rows from each of the others.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def keep_first(
    df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key: the first by ``order``, by all other columns if none given.

    The order makes the choice the same in every run and after every retry.
    """
    if order is None:
        order = [name for name in df.columns if name not in key] or list(key)
    return top_per_group(df, key, order, 1, rank="_place").drop("_place")
