"""Connected components by alternating large and small stars, all of it joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import Scratch


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, which may be the node itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_least(both), "u").filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.union(own).filter("u != v").distinct()


def _signature(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every node that has a link.

    Self-links and null ends link nothing. Runs until the stars no longer change.
    """
    scratch = Scratch(edges.sparkSession)
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    links = scratch.table(links, "edges")
    before, done = None, _signature(links)
    while before != done:
        large = scratch.table(_large_star(links), "large-star")
        links = scratch.table(_small_star(large), "small-star")
        before, done = done, _signature(links)
    roots = links.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    members = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    result = scratch.result(members.union(roots), "components")
    scratch.clear()
    return result
