import hashlib
import math
import random

import compare
import pytest
from pyspark.errors import PySparkException

from barlake.llm import clustering
from barlake.llm.oracle import statements
from barlake.llm.queries import registered

DDL = "vec_id long, embedding array<double>"


def brute(rows, dims, k, rounds, scale=1024, seed="3"):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, group in groups.items():
            centroids[n] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = {}
    for _, n, d in found:
        own[n] = own.get(n, 0) + d
    total = sum(own.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, own[n], total, sha[n]) for i, n, d in found), key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, DDL)
    got = sorted((tuple(r) for r in clustering.cluster(df, **options).collect()), key=str)
    rounds = options.pop("rounds", 10)
    options.pop("width", None)
    assert got == brute(rows, options["dims"], options["k"], rounds)
    return got


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_equals_plain_version(spark, width):
    rng = random.Random(width)
    rows = [(n, [rng.gauss(n % 4, 0.4) for _ in range(5)]) for n in range(300)]
    check(spark, rows, dims=5, k=6, rounds=4, width=width)


def test_small_chunks_and_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(clustering, "CHUNK_ROWS", 7)
    rng = random.Random(9)
    rows = [(n, [0.25, -0.5, 3.0]) for n in range(200)]
    rows += [(1000 + n, [rng.uniform(-2, 2) for _ in range(3)]) for n in range(100)]
    check(spark, rows, dims=3, k=8)


def test_ties_and_empty_clusters(spark):
    got = check(spark, [(n, [1.0, 1.0]) for n in range(20)], dims=2, k=4)
    assert {r[1] for r in got} == {0}
    check(spark, [(n, [float(n % 2), 0.0]) for n in range(12)], dims=2, k=3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [0.0, -inf]), (7, [0.1, -0.1])]
    rows += [(None, [2.0, 2.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (8, [-0.5, 7.0]), (9, [-0.0001, 0.0])]
    got = check(spark, rows, dims=2, k=8)
    assert len(got) == 6


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, [(5, [1.0, 2.0]), (6, [3.0, 4.0])], dims=2, k=8)
    none = clustering.cluster(spark.createDataFrame([(1, [1.0])], DDL), dims=2)
    assert none.collect() == [] and "centroid_sha256" in none.columns


def test_clashing_names_and_float_vectors(spark):
    df = spark.createDataFrame([(1, "x", [1.5, 2.5]), (2, "y", [9.0, 9.0])], "`a.id` int, id string, v array<float>")
    got = clustering.cluster(df, "a.id", "v", dims=2, k=1, rounds=1)
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


def test_too_large_component(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], DDL)
    with pytest.raises(PySparkException, match="beyond"):
        clustering.cluster(df, dims=2).collect()


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    with compare.connect(sf) as connection:
        name = "op12_clustering"
        assert compare.differences(registered()[name](spark, sf), connection, statements()[name]) is None
