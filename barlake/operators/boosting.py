"""Gradient-boosted trees over stored bins (L-3, L-4, L-8): MLlib's method, MLlib's models.

MLlib visits every row as objects, once per level and once more per tree. Here the rows are written once, as bins of the
features (two features share two bytes) and the label, thousands of rows in one binary value. A level of a tree is one pass
of numpy over them: each task adds up the count, sum and sum of squares of the residuals by node, feature and bin, and the
driver adds the tasks' few thousand numbers and picks the splits as MLlib does. The predictions so far are stored with the
rows every ``CARRIED`` trees; those of the trees since are worked out again in each pass. Every row is read in every pass.

The split candidates follow MLlib's rule. Up to ``EXACT_ROWS`` rows they come from all values, as there; above, where MLlib
draws that many rows at random, they come from evenly spaced ranks among all rows of each task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.storage import materialized

# The tasks' Python need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXACT_ROWS = 10_000
RANKS = 1 << 9
CHUNK_ROWS = 1 << 14
CARRIED = 4
# Bins hardly compress, and a task holds no more than one row group and one batch.
STORED = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}
BATCH_BYTES = "2m"
CHUNK_DDL = "codes BINARY, label BINARY, predicted BINARY"
RANKS_DDL = "n BIGINT, feature INT, ranks BINARY"
# A node purer than this is not split further.
PURE = 2.0**-52


@dataclass(frozen=True)
class Bins:
    """Thresholds of each feature; a value's bin is the number of thresholds below it."""

    thresholds: list[np.ndarray]

    def count(self, feature: int) -> int:
        return len(self.thresholds[feature]) + 1 if feature < len(self.thresholds) else 1

    @property
    def pairs(self) -> int:
        return (len(self.thresholds) + 1) // 2

    def width(self, pair: int) -> int:
        """Places for the bins of a pair's second feature, a power of two."""
        return 1 << (self.count(2 * pair + 1) - 1).bit_length()

    def codes(self, values: list[np.ndarray]) -> np.ndarray:
        """One row per pair of features: their bins as one number."""
        found = [np.searchsorted(t, v, side="left") for t, v in zip(self.thresholds, values, strict=True)]
        found.append(np.zeros(len(found[0]), np.int64))
        return np.array([found[2 * p] * self.width(p) + found[2 * p + 1] for p in range(self.pairs)], np.uint16)

    def above(self, codes: np.ndarray, feature: int, cut: int) -> np.ndarray:
        """Whether each row's bin of the feature lies behind the threshold ``cut``."""
        width = self.width(feature // 2)
        if feature % 2 == 0:
            return codes[feature // 2] >= (cut + 1) * width
        return codes[feature // 2] & np.uint16(width - 1) > cut


@dataclass
class Tree:
    """Nodes by heap number: the root is 1, node i has the children 2i and 2i + 1."""

    depth: int
    splits: dict[int, tuple[int, int, float]] = field(default_factory=dict)  # feature, threshold, gain
    stats: dict[int, np.ndarray] = field(default_factory=dict)  # count, sum, sum of squares
    unsplittable: set[int] = field(default_factory=set)

    def nodes(self, bins: Bins, codes: np.ndarray, level: int) -> np.ndarray:
        """Place of each row's node among those of a level; below a leaf rows keep to the left."""
        place = np.zeros(codes.shape[1], np.uint8 if level <= 8 else np.uint32)
        for upper in range(level):
            first = 1 << upper
            right = np.zeros(len(place), bool)
            for node in range(first, 2 * first):
                if node in self.splits:
                    feature, cut, _ = self.splits[node]
                    side = bins.above(codes, feature, cut)
                    right |= side & (place == node - first) if upper else side
            place = place * 2 + right
        return place

    def values(self) -> np.ndarray:
        """Prediction of each place on the lowest level."""
        first = 1 << self.depth
        out = np.zeros(first)
        for place in range(first):
            node = first + place
            while node not in self.stats:
                node //= 2
            out[place] = self.stats[node][1] / self.stats[node][0]
        return out

    def predict(self, bins: Bins, codes: np.ndarray) -> np.ndarray:
        return self.values()[self.nodes(bins, codes, self.depth)]


def impurity(stats: np.ndarray) -> np.ndarray:
    """Variance from count, sum and sum of squares, along the first axis."""
    count, total, squares = stats
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count > 0, (squares - total * total / count) / count, 0.0)


def best_split(stats: list[np.ndarray]) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
    """Feature, threshold, gain and both sides' statistics; the first of equal gains, None without any gain.

    ``stats`` holds, per feature, count, sum and sum of squares by bin.
    """
    best = None
    for feature, by_bin in enumerate(stats):
        if by_bin.shape[1] < 2:
            continue
        summed = by_bin.cumsum(axis=1)
        left, total = summed[:, :-1], summed[:, -1:]
        right = total - left
        parts = (left[0] * impurity(left) + right[0] * impurity(right)) / total[0]
        gain = np.where((left[0] >= 1) & (right[0] >= 1), impurity(total) - parts, -np.inf)
        cut = int(gain.argmax())
        if gain[cut] > (best[2] if best else 0.0):
            best = feature, cut, float(gain[cut]), left[:, cut], right[:, cut]
    return best


def split_candidates(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """MLlib's thresholds of a continuous feature: between neighbours, as even in rows as ties allow."""
    distinct, place = np.unique(values + 0.0, return_inverse=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    summed = np.bincount(place, weights).cumsum()
    stride = summed[-1] / (most + 1)
    target, chosen = stride, []
    for i in range(len(middles)):
        if abs(summed[i] - target) < abs(summed[i + 1] - target):
            chosen.append(middles[i])
            target += stride
    return np.array(chosen)


def even_ranks(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``RANKS`` values that stand for equal weights, in order."""
    order = values.argsort(kind="stable")
    summed = weights[order].cumsum()
    wanted = (np.arange(RANKS) + 0.5) * (summed[-1] / RANKS)
    return values[order][np.minimum(summed.searchsorted(wanted), len(order) - 1)]


def task_ranks(values: DataFrame) -> DataFrame:
    """From each task and for each column, evenly spaced ranks of all its values, by way of those of its chunks."""
    names = values.columns

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        sizes: list[int] = []
        ranks: list[list[np.ndarray]] = [[] for _ in names]

        def close() -> None:
            table = pa.Table.from_batches(held)
            sizes.append(table.num_rows)
            at = ((np.arange(RANKS) + 0.5) * (table.num_rows / RANKS)).astype(np.int64)
            for name, into in zip(names, ranks, strict=True):
                into.append(np.sort(table[name].to_numpy())[at])
            held.clear()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                close()
        if sum(b.num_rows for b in held):
            close()
        if sizes:
            weights = np.repeat(np.array(sizes) / RANKS, RANKS)
            found = [even_ranks(np.concatenate(r), weights).tobytes() for r in ranks]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sum(sizes)] * len(names), pa.int64()),
                    pa.array(range(len(names)), pa.int32()),
                    pa.array(found, pa.binary()),
                ],
                ["n", "feature", "ranks"],
            )

    return values.mapInArrow(summarise, RANKS_DDL)


def find_bins(rows: DataFrame, features: list[str], max_bins: int = 32) -> Bins:
    """The thresholds of all features, from one pass over all rows."""
    values = rows.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    found = task_ranks(values).collect()
    n = sum(r["n"] for r in found if r["feature"] == 0)
    if not n:
        raise ValueError("no complete rows to learn from")
    most = min(max_bins, n) - 1
    if n <= EXACT_ROWS:
        whole = values.toArrow()
        return Bins([split_candidates(whole[c].to_numpy(), np.ones(n), most) for c in values.columns])
    thresholds = []
    for feature in range(len(features)):
        parts = [(r["n"], np.frombuffer(r["ranks"])) for r in found if r["feature"] == feature]
        weights = np.concatenate([np.full(len(ranks), count / len(ranks)) for count, ranks in parts])
        thresholds.append(split_candidates(np.concatenate([ranks for _, ranks in parts]), weights, most))
    return Bins(thresholds)


def binned_chunks(rows: DataFrame, features: list[str], label: str, bins: Bins, classes: bool) -> DataFrame:
    """``codes`` and ``label`` of up to ``CHUNK_ROWS`` rows in each row, and their predictions, none yet."""
    names = [f"f{i}" for i in range(len(features))]

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        codes = bins.codes([table[c].to_numpy() for c in names])
        labels = table["label"].to_numpy()
        if classes:
            if not np.isin(labels, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            labels = labels * 2 - 1
        data = [pa.array([a.tobytes()], pa.binary()) for a in (codes, labels, np.zeros(0))]
        return pa.RecordBatch.from_arrays(data, ["codes", "label", "predicted"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, CHUNK_ROWS - count))
                count += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if count == CHUNK_ROWS:
                    yield row(held)
                    held, count = [], 0
        if held:
            yield row(held)

    values = [F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)]
    return rows.select(*values, F.col(label).cast("double").alias("label")).mapInArrow(encode, CHUNK_DDL)


def label_itself(labels: np.ndarray, predicted: np.ndarray) -> np.ndarray:
    """What the first tree learns."""
    return labels


def squared_residuals(labels: np.ndarray, predicted: np.ndarray) -> np.ndarray:
    """The negative gradient of the squared error."""
    return 2 * (labels - predicted)


def logistic_residuals(labels: np.ndarray, predicted: np.ndarray) -> np.ndarray:
    """The negative gradient of the log loss, for labels of -1 and 1."""
    with np.errstate(over="ignore"):
        return 4 * labels / (1 + np.exp(2 * labels * predicted))


def _read(batch: pa.RecordBatch, bins: Bins) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes, labels and stored predictions of each chunk; before any tree the predictions are zero."""
    for codes, labels, predicted in zip(*(batch[n] for n in ("codes", "label", "predicted")), strict=True):
        labels, predicted = (np.frombuffer(a.as_buffer(), np.float64) for a in (labels, predicted))
        yield (
            np.frombuffer(codes.as_buffer(), np.uint16).reshape(bins.pairs, -1),
            labels,
            predicted if len(predicted) else np.zeros(len(labels)),
        )


def carried(chunks: DataFrame, bins: Bins, trees: list[Tree], weights: list[float]) -> DataFrame:
    """The chunks with the trees' predictions added to those stored."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for codes, _, predicted in _read(batch, bins):
                for tree, weight in zip(trees, weights, strict=True):
                    predicted = predicted + weight * tree.predict(bins, codes)
                sums.append(predicted.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["codes"], batch["label"], pa.array(sums, pa.binary())], ["codes", "label", "predicted"]
            )

    return chunks.mapInArrow(add, CHUNK_DDL)


def level_stats(
    chunks: DataFrame, bins: Bins, trees: list[Tree], weights: list[float], growing: Tree, level: int, residuals
) -> list[np.ndarray]:
    """For each feature, count, sum and sum of squares of the residuals by node of the level and bin.

    ``trees`` are those whose predictions are not stored yet; ``residuals`` takes labels and predictions.
    """
    nodes, features = 1 << level, len(bins.thresholds)
    sizes = [bins.count(2 * p) * bins.width(p) for p in range(bins.pairs)]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((3, nodes * size)) for size in sizes]
        for batch in batches:
            for codes, labels, predicted in _read(batch, bins):
                for tree, weight in zip(trees, weights, strict=True):
                    predicted = predicted + weight * tree.predict(bins, codes)
                values = residuals(labels, predicted)
                squares = values * values
                place = growing.nodes(bins, codes, level).astype(np.intp)
                for pair, (size, into) in enumerate(zip(sizes, sums, strict=True)):
                    cell = place * size + codes[pair]
                    into[0] += np.bincount(cell, minlength=nodes * size)
                    into[1] += np.bincount(cell, values, nodes * size)
                    into[2] += np.bincount(cell, squares, nodes * size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate(sums, axis=1).tobytes()], pa.binary())], ["sums"]
        )

    parts = chunks.mapInArrow(total, "sums BINARY").toArrow()["sums"]
    summed = np.zeros((3, nodes * sum(sizes)))
    for part in parts:
        summed += np.frombuffer(part.as_buffer(), np.float64).reshape(summed.shape)
    found, start = [], 0
    for pair, size in enumerate(sizes):
        shape = (3, nodes, bins.count(2 * pair), bins.width(pair))
        joint = summed[:, start : start + nodes * size].reshape(shape)
        found += [joint.sum(axis=3), joint.sum(axis=2)[:, :, : bins.count(2 * pair + 1)]]
        start += nodes * size
    return found[:features]


def grow_tree(
    chunks: DataFrame, bins: Bins, trees: list[Tree], weights: list[float], depth: int, residuals
) -> Tree:
    """The next tree: one pass per level."""
    tree = Tree(depth)
    open_nodes = [1]
    for level in range(max(depth, 1)):
        stats = level_stats(chunks, bins, trees, weights, tree, level, residuals)
        following = []
        for node in open_nodes:
            mine = [s[:, node - (1 << level)] for s in stats]
            if node == 1:
                tree.stats[1] = mine[0].sum(axis=1)
            split = best_split(mine) if depth else None
            if split is None:
                tree.unsplittable.add(node)
                continue
            feature, cut, gain, left, right = split
            tree.splits[node] = feature, cut, gain
            for child, side in ((2 * node, left), (2 * node + 1, right)):
                tree.stats[child] = side
                if level + 1 < depth and abs(impurity(side)) >= PURE:
                    following.append(child)
        open_nodes = following
        if not open_nodes:
            break
    return tree


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to the tasks' Python in batches of bounded size, meanwhile."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def boost(
    rows: DataFrame, features: list[str], label: str, classes: bool, depth: int, rounds: int, step: float
) -> tuple[Bins, list[Tree], list[float]]:
    """Trees and their weights; the first learns the label with full weight, the others the residuals."""
    bins = find_bins(rows, features)
    trees: list[Tree] = []
    weights: list[float] = []
    stored = ExitStack()
    try:
        chunks = stored.enter_context(
            materialized(binned_chunks(rows, features, label, bins, classes), "binned", STORED)
        )
        known = 0
        for _ in range(rounds):
            residuals = (logistic_residuals if classes else squared_residuals) if trees else label_itself
            trees.append(grow_tree(chunks, bins, trees[known:], weights[known:], depth, residuals))
            weights.append(step if weights else 1.0)
            if len(trees) % CARRIED == 0 and len(trees) < rounds:
                following = ExitStack()
                chunks = following.enter_context(
                    materialized(carried(chunks, bins, trees[known:], weights[known:]), "binned", STORED)
                )
                known = len(trees)
                stored.close()
                stored = following
    finally:
        stored.close()
    return bins, trees, weights


def _java_node(spark: SparkSession, bins: Bins, tree: Tree, node: int = 1):
    """MLlib's node; two leaves of one prediction become one leaf, as there."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kinds = jvm.org.apache.spark.ml.tree
    array = gateway.new_array(jvm.double, 3)
    for i, value in enumerate(tree.stats[node]):
        array[i] = float(value)
    stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(array, int(tree.stats[node][0]))
    spread = -1.0 if node in tree.unsplittable else float(impurity(tree.stats[node]))
    if node in tree.splits:
        feature, cut, gain = tree.splits[node]
        left, right = (_java_node(spark, bins, tree, child) for child in (2 * node, 2 * node + 1))
        leaves = all(child.subtreeDepth() == 0 for child in (left, right))
        if not leaves or left.prediction() != right.prediction():
            split = kinds.ContinuousSplit(feature, float(bins.thresholds[feature][cut]))
            return kinds.InternalNode(stats.predict(), spread, gain, left, right, split, stats)
    return kinds.LeafNode(stats.predict(), spread, stats)


def fit_boosted(
    estimator: GBTClassifier | GBTRegressor, rows: DataFrame, features: list[str]
) -> GBTClassificationModel | GBTRegressionModel:
    """What ``estimator.fit`` gives for the assembled features of complete rows, by its depth, rounds and step."""
    spark = rows.sparkSession
    classes = isinstance(estimator, GBTClassifier)
    with small_batches(spark):
        bins, trees, weights = boost(
            rows, features, estimator.getLabelCol(), classes,
            estimator.getMaxDepth(), estimator.getMaxIter(), estimator.getStepSize(),
        )
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    java_trees, java_weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        java_trees[i] = kind(_java_node(spark, bins, tree), len(features))
        java_weights[i] = weight
    if classes:
        made = jvm.org.apache.spark.ml.classification.GBTClassificationModel
        model = GBTClassificationModel(made(estimator.uid, java_trees, java_weights, len(features), 2))
    else:
        made = jvm.org.apache.spark.ml.regression.GBTRegressionModel
        model = GBTRegressionModel(made(estimator.uid, java_trees, java_weights, len(features)))
    return estimator._copyValues(model)
