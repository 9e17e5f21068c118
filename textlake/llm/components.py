"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch


def _signature(edges: DataFrame) -> tuple:
    """Tells whether a set of edges changed: their number and two sums over them."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v") % 1_000_000_007),
            F.sum(F.xxhash64("v", "u", F.lit(1)) % 998_244_353),
        ).first()
    )


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each ``v`` hung on the least node that its ``u`` knows."""
    met = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return met.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (the least node reached) for every node that has an edge.

    ``edges`` has nodes ``u, v`` in any direction, repeated or not. Large and small stars
    alternate: neighbours are hung on the least node seen, first those above a node and
    then those below, until nothing changes; a chain halves in every round. A node's
    neighbours are never gathered: only their least is, by an aggregate.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = scratch.keep(links.where("u <> v").distinct(), "edges")
    before = None
    while (signature := _signature(now)) != before:
        before = signature
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = scratch.keep(_star(both.where("v > u"), least), "large")
        # Every edge leads down now: u > v. The small star also keeps u itself.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        kept = _star(large, least).unionByName(least.select("u", F.col("least").alias("v")))
        after = scratch.keep(kept.distinct(), "small")
        scratch.drop(now, large)
        now = after
    # Stars: every node points at the least of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
