"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root``, the least node that links reach, for each node but the roots.

    ``links`` has columns ``a`` and ``b``, not null. Rounds of large and small stars: every
    node's larger neighbours move to its least neighbour, then its smaller ones do, until
    nothing changes. A node with most of the links is many rows, joined with one.
    """
    edges = scratch.keep(
        links.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        before = state
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(
            edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select("u", F.least("u", "least").alias("least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("node"), F.col("least").alias("root"))
        large = scratch.keep(large.distinct())
        first = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(first, "node")
        moved = small.where("root != least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        after = first.select("node", F.col("least").alias("root")).union(moved).distinct()
        old, edges = edges, scratch.keep(after)
        scratch.drop(old, large)
