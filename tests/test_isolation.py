import math
import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from barlake.operators import isolation as iso

FEATURES = ("a", "b")
DDL = "symbol string, i int, a double, b double"


def frame(spark, seed, count=300):
    rng = random.Random(seed)
    rows = [("S", i, rng.gauss(0, 1), rng.gauss(5, 2)) for i in range(count)]
    rows += [("X", 0, 40.0, 5.0), ("X", 1, 0.0, -90.0), ("X", 2, 30.0, 70.0)]
    return spark.createDataFrame(rows, DDL)


def uniforms(spark, *columns, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    return {tuple(r)[:-1]: r.u for r in df.withColumn("u", iso.uniform(*columns)).collect()}


def brute(spark, data, trees, sample, seed):
    """The same forest and scores, row by row."""
    rows = [(r.symbol, r.i, (r.a, r.b)) for r in data.collect()]
    keys = [(t, s, i) for t in range(trees) for s, i, _ in rows]
    order = uniforms(spark, F.lit(seed), "tree", "symbol", "i", rows=keys, ddl="tree int, symbol string, i int")
    nodes = [(t, n) for t in range(trees) for n in range(1, 1 << 9)]
    pick = uniforms(spark, F.lit(seed), F.lit("feature"), "tree", "node", rows=nodes, ddl="tree int, node int")
    part = uniforms(spark, F.lit(seed), F.lit("cut"), "tree", "node", rows=nodes, ddl="tree int, node int")
    depth = math.ceil(math.log2(sample))

    def grow(tree, node, held):
        able = [f for f in (0, 1) if max(x[f] for x in held) > min(x[f] for x in held)]
        if node.bit_length() > depth or not able:
            return len(held)
        f = able[int(pick[tree, node] * len(able))]
        lo, hi = min(x[f] for x in held), max(x[f] for x in held)
        cut = hi - (hi - lo) * part[tree, node]
        sides = [x for x in held if x[f] < cut], [x for x in held if x[f] >= cut]
        return f, cut, grow(tree, 2 * node, sides[0]), grow(tree, 2 * node + 1, sides[1])

    def path(tree, x, depth=0):
        if isinstance(tree, int):
            return depth + iso.mean_depth(tree)
        f, cut, left, right = tree
        return path(right if x[f] >= cut else left, x, depth + 1)

    forest = []
    for t in range(trees):
        first = sorted((order[t, s, i], s, i, x) for s, i, x in rows if order[t, s, i] < 4 * sample / len(rows))
        forest.append(grow(t, 1, [x for *_, x in first[:sample]]))
    usual = iso.mean_depth(min(sample, len(rows)))
    return {(s, i): 2 ** (-sum(path(t, x) for t in forest) / trees / usual) for s, i, x in rows}


def scores(data, **options):
    forest = iso.fit_forest(data, ["symbol", "i"], FEATURES, **options)
    return {(r.symbol, r.i): r for r in iso.with_isolation(data, ["symbol", "i"], forest).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_forest(spark, seed):
    data = frame(spark, seed)
    got = scores(data, trees=20, sample=64, seed=seed)
    expected = brute(spark, data, 20, 64, seed)
    assert {k: r.isolation_score for k, r in got.items()} == pytest.approx(expected, rel=1e-9)


def test_planted_rows_are_found(spark):
    got = scores(frame(spark, 4))
    planted = [got["X", i] for i in range(3)]
    usual = sorted(r.isolation_score for key, r in got.items() if key[0] == "S")
    assert all(r.is_isolated for r in planted) and min(r.isolation_score for r in planted) > usual[-1]
    assert usual[len(usual) // 2] < 0.5


def test_order_and_partitions_do_not_matter(spark):
    data = frame(spark, 3, 100)
    first = scores(data, trees=5, sample=32)
    again = scores(data.orderBy("a").repartition(7), trees=5, sample=32)
    assert {k: r.isolation_score for k, r in first.items()} == pytest.approx(
        {k: r.isolation_score for k, r in again.items()}
    )


def test_missing_features_equal_rows_and_no_rows(spark):
    odd = spark.createDataFrame([("A", 1, None, 1.0), ("A", 2, float("nan"), 1.0), ("A", 3, float("inf"), 1.0)], DDL)
    same = spark.createDataFrame([("B", i, 1.0, 1.0) for i in range(10)], DDL)
    got = scores(odd.unionByName(same), trees=3, sample=8)
    assert [got["A", i].isolation_score for i in (1, 2, 3)] == [None] * 3
    assert not any(r.is_isolated for r in got.values())
    assert scores(same.limit(0)) == {}
    assert scores(odd)["A", 1].isolation_score is None


def test_scoring_neither_copies_nor_shuffles_rows(spark):
    data = frame(spark, 5, 60)
    plan = plan_of(iso.with_isolation(data, ["symbol", "i"], iso.fit_forest(data, ["symbol", "i"], FEATURES, trees=3, sample=16)))
    assert "Generate" not in plan and "Exchange" not in plan
