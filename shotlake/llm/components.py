"""Connected components by alternating large and small stars, without a hot partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize

#: A round halves the longest path at least, so that no graph needs as many.
ROUNDS = 100


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link the neighbours of each node (the larger, or with ``small`` the smaller ones) to the least of them."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both.filter("v < u") if small else both
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"), F.count("*").alias("n"))
    linked = lookup(near, materialize(least, "star-least"), ["u"], "n")
    if small:
        rows = linked.select(F.col("v").alias("a"), F.col("least").alias("b")).unionByName(linked.select(F.col("u").alias("a"), F.col("least").alias("b")))
    else:
        rows = linked.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    return materialize(rows.filter("a <> b").distinct(), "star")


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end is linked with one smaller end only, which has no smaller one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").count()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) of all nodes in ``links`` (a, b: bigint) but the least ones."""
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    for _ in range(ROUNDS):
        if _stars(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = _star(_star(edges, False), True)
    raise RuntimeError(f"components are not final after {ROUNDS} rounds")
