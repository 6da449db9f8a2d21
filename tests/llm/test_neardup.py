import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import components as cc
from barlake.llm import neardup as nd
from barlake.llm.queries import registered


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def union(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in (x for x in links if x[0] != x[1]):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(docs, size, percent=80):
    sets = {k: shingles(t, size) for k, t in docs}
    held = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            held[x].append(k)
    shared = collections.Counter((a, b) for v in held.values() for i, a in enumerate(v) for b in v[i + 1 :])
    links = [p for p, n in shared.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    return {k: (len(sets[k]), c) for k, c in union(links, sets).items()}


def got(spark, docs, size):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(frame, size).collect()}


def corpus(seed, n_copies=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base = [word() for _ in range(90)]
    texts = [None, "", " \n", "one two", "One TWO", "a b c d", "a b c d e"]
    for _ in range(n_copies):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 30
    for _ in range(60):
        own = [word() for _ in range(rng.randint(3, 60))]
        texts.append(" ".join(own))
        if rng.random() < 0.5:
            own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own).upper())
    texts += [" ".join([*base[:20], *(word() for _ in range(40))]) for _ in range(20)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("size", [4, 5])
def test_matches_brute_force(spark, size):
    docs = corpus(size)
    wanted = brute(docs, size)
    assert got(spark, docs, size) == wanted
    # The group falls into parts that only the comparison of leftovers can join.
    assert len({c for _, c in wanted.values()}) > 40


def test_small_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "PART", 5)
    monkeypatch.setattr(nd, "BLOCK", 7)
    docs = corpus(7)
    assert got(spark, docs, 4) == brute(docs, 4)


def test_rows_without_or_with_repeated_keys(spark):
    text = "one two three four five six seven"
    docs = [(1, text), (1, text), (2, text), (None, text), (3, None), (5, "x y z"), (5, text)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"key": F.lit("x"), "n": F.lit(1)})
    rows = sorted(((r["id"], r["component_id"]) for r in nd.near_duplicates(frame, 4).collect()), key=str)
    assert rows[:3] == [(1, 1), (1, 1), (2, 1)]
    assert (3, 3) in rows and len(rows) == 7
    kept = nd.keep_one(frame, 4)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 3, None}
    assert 2 not in {r["doc_id"] for r in kept.collect()}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(frame).collect() == []
    assert nd.keep_one(frame).collect() == []


def test_estimates_are_close_and_corrected():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        values = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2))
        a, b = np.sort(values[:2400]), np.sort(values[600:])
        one, two = nd.registers(a, 8), nd.registers(b, 8)
        errors.append(nd.estimates(one, two[None, :])[0][0] - len(np.intersect1d(a, b)) / len(values))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(5, 5)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = {r["id"]: r["component"] for r in cc.connected_components(frame).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert rows == union(edges, nodes)


def test_random_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    rows = {r["id"]: r["component"] for r in cc.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert rows == union(edges, {n for a, b in edges if a != b for n in (a, b)})


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = registered()["op5_near_duplicates"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(docs, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
