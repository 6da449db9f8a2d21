"""Isolation forest over bars (W-15, beside the z-score of volume).

A tree cuts a small sample of rows at random places of random features until rows are alone; rows that
are alone after few cuts are unusual. Every random choice is a hash of the seed, the tree
and the node or row, so a forest is the same wherever its rows lie. The sample of a tree is the
``sample`` rows of smallest hash, a bound that belongs to the method; every row is scored.

Trees grow level by level: a level is one aggregate over the samples, and its cuts, at most
``trees * 2**level`` rows whatever the data, go to the driver and back as a broadcast table. Scoring walks batches
of rows down all trees with numpy, in the tasks that read them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.storage import materialized

# Euler's constant, for the mean depth of a search tree.
GAMMA = 0.5772156649015329

CUTS_DDL = "tree INT, node INT, feature INT, cut DOUBLE"
LEAVES_DDL = "tree INT, node INT, size INT"


@dataclass(frozen=True)
class Forest:
    """Cuts and leaves of all trees; node 1 is a root, node n has the children 2n and 2n + 1."""

    features: tuple[str, ...]
    trees: int
    depth: int
    sample: int
    cuts: list[tuple[int, int, int, float]]
    leaves: list[tuple[int, int, int]]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def mean_depth(size: float) -> float:
    """Cuts that a search among ``size`` rows takes on average."""
    if size <= 1:
        return 0.0
    return 1.0 if size == 2 else 2 * (math.log(size - 1) + GAMMA) - 2 * (size - 1) / size


def _usable(values: list[Column]) -> list[Column]:
    return [v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))) for v in values]


def _complete(rows: DataFrame, keys: list[str], features: tuple[str, ...]) -> DataFrame:
    """Keys and an array of features of the rows that have all of them as finite numbers."""
    values = [F.col(c).cast("double") for c in features]
    kept = rows
    for condition in _usable(values):
        kept = kept.filter(condition)
    return kept.select(*keys, F.array(*values).alias("x"))


def samples(complete: DataFrame, keys: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """``tree`` and ``x`` of the rows each tree learns from."""
    count = complete.count()
    if not count:
        return complete.select(F.lit(0).alias("tree"), "x").limit(0)
    drawn = complete.select(*keys, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.withColumn("u", uniform(F.lit(seed), "tree", *keys))
    # Rows that are four times too far back for the sample need no sorting.
    near = drawn.filter(F.col("u") < 4.0 * sample / count)
    first = F.row_number().over(Window.partitionBy("tree").orderBy("u", *keys))
    return near.withColumn("place", first).filter(F.col("place") <= sample).select("tree", "x")


def _level(rows: DataFrame, count: int, seed: int) -> DataFrame:
    """Size of each node and, where it can be cut, feature and place of the cut."""
    lows = [F.min(F.col("x")[i]).alias(f"lo{i}") for i in range(count)]
    highs = [F.max(F.col("x")[i]).alias(f"hi{i}") for i in range(count)]
    nodes = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).cast("int").alias("size"), *lows, *highs)
    able = F.filter(
        F.array(*[F.when(F.col(f"hi{i}") > F.col(f"lo{i}"), F.lit(i)) for i in range(count)]),
        lambda i: i.isNotNull(),
    )
    pick = F.floor(uniform(F.lit(seed), F.lit("feature"), "tree", "node") * F.size("able")).cast("int")
    chosen = nodes.withColumn("able", able).withColumn("feature", F.get("able", pick))
    lo, hi = (F.get(F.array(*[f"{side}{i}" for i in range(count)]), "feature") for side in ("lo", "hi"))
    part = uniform(F.lit(seed), F.lit("cut"), "tree", "node")
    return chosen.select("tree", "node", "size", "feature", (hi - (hi - lo) * part).alias("cut"))


def _descend(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows in a node that is cut move to one of its children; the cut belongs to the upper one."""
    right = (F.get("x", "feature") >= F.col("cut")).cast("int")
    moved = F.when(F.col("cut").isNotNull(), F.col("node") * 2 + right).otherwise(F.col("node"))
    joined = rows.join(F.broadcast(cuts), ["tree", "node"], "left")
    return joined.withColumn("node", moved).drop("feature", "cut")


def fit_forest(
    rows: DataFrame, keys: list[str], features: tuple[str, ...], trees: int = 50, sample: int = 256, seed: int = 7
) -> Forest:
    """Learn a forest. ``keys`` identify a row; rows with a missing feature teach nothing."""
    spark = rows.sparkSession
    depth = max(1, math.ceil(math.log2(sample)))
    cuts: list[tuple[int, int, int, float]] = []
    leaves: list[tuple[int, int, int]] = []
    with materialized(samples(_complete(rows, keys, features), keys, trees, sample, seed), "samples") as drawn:
        growing = drawn.withColumn("node", F.lit(1))
        for level in range(depth + 1):
            found = _level(growing, len(features), seed).filter(F.col("node") >= 1 << level).collect()
            new = [(r["tree"], r["node"], r["feature"], r["cut"]) for r in found if r["cut"] is not None and level < depth]
            inner = {(tree, node) for tree, node, *_ in new}
            leaves += [(r["tree"], r["node"], r["size"]) for r in found if (r["tree"], r["node"]) not in inner]
            cuts += new
            if not new:
                break
            growing = _descend(growing, spark.createDataFrame(new, CUTS_DDL))
    return Forest(features, trees, depth, sample, sorted(cuts), sorted(leaves))


def _mean_path(forest: Forest) -> Callable[[Column], Column]:
    """The mean path of a row's array of features over the trees.

    The forest is a few arrays by tree and node, so a batch of rows walks down each tree at once; rows are neither
    copied per tree nor shuffled.
    """
    shape = (forest.trees, 1 << (forest.depth + 1))
    feature, cut, path = np.full(shape, -1), np.zeros(shape), np.full(shape, np.nan)
    for tree, node, chosen, place in forest.cuts:
        feature[tree, node], cut[tree, node] = chosen, place
    # A leaf's path: its depth, and what cutting its sample rows further would have taken.
    for tree, node, size in forest.leaves:
        path[tree, node] = node.bit_length() - 1 + mean_depth(size)
    depth = forest.depth

    def walk(x: pd.Series) -> pd.Series:
        total, reached = np.zeros(len(x)), np.zeros(len(x))
        if len(x):
            values = np.stack(x.to_numpy())
            rows = np.arange(len(x))
            for features, cuts, paths in zip(feature, cut, path, strict=True):
                node = np.ones(len(x), dtype=np.int64)
                for _ in range(depth):
                    f = features[node]
                    node = np.where(f >= 0, 2 * node + (values[rows, f] >= cuts[node]), node)
                found = paths[node]
                total += np.nan_to_num(found)
                reached += ~np.isnan(found)
        return pd.Series(total / np.maximum(reached, 1))

    return F.pandas_udf(walk, "double")


def with_isolation(
    rows: DataFrame, keys: list[str], forest: Forest, limit: float = 0.65
) -> DataFrame:
    """W-15: ``isolation_score`` (near 1: unusual, below 0.5: not) and its flag; rows with a
    missing feature have no score and are not flagged."""
    values = [F.col(c).cast("double") for c in forest.features]
    usable = reduce(lambda a, b: a & b, _usable(values))
    sizes: dict[int, int] = {}
    for tree, _, size in forest.leaves:
        sizes[tree] = sizes.get(tree, 0) + size
    # A small table gives smaller samples than asked for.
    usual = mean_depth(sum(sizes.values()) / len(sizes)) if sizes else 0.0
    score = F.lit(None).cast("double")
    if usual:
        x = F.when(usable, F.array(*values)).otherwise(F.array(*[F.lit(0.0) for _ in values]))
        score = F.when(usable, F.pow(F.lit(2.0), -_mean_path(forest)(x) / usual))
    scored = rows.withColumn("isolation_score", score)
    return scored.withColumn("is_isolated", F.coalesce(F.col("isolation_score") > limit, F.lit(False)))
