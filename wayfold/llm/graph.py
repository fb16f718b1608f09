"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node in ``edges`` (long columns ``a``, ``b``); the root is the smallest node it reaches.

    Each round ties every node to the smallest of its neighbourhood, first for larger neighbours, then for smaller ones;
    rounds grow with the logarithm of the longest chain. A node's neighbours are never gathered: the minimum is combined
    before the shuffle and joined back, and a join with a hot node can be split. Minima and rounds are written tables. Loops
    and nulls are ignored; repeated edges count once; no edges give no rows.
    """
    now = durable(
        edges.where((F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components"
    )
    before = _state(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = durable(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "components")
        large = both.join(least, both.a == least.u).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        large = durable(large, "components")
        down = durable(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"), "components")
        small = large.join(down, large.a == down.u).select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("u", "m"))
        now = durable(small.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return stars.union(now.select("b", "b").distinct().join(stars.select(F.col("node").alias("b")), "b", "left_anti").selectExpr("b as node", "b as root"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free check sum of them."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h
