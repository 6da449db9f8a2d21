import math
import random
import re

import compare
import pytest

from barlake.llm import lexical_search
from barlake.llm.oracle import statements
from barlake.llm.queries import registered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(docs, queries, top):
    lists = [(i, words(t)) for i, t in docs]
    total = sum(len(w) for _, w in lists)
    count = sum(1 for _, w in lists if w)
    out = []
    for item, text in queries:
        scored = []
        for doc, found in lists:
            score = 0
            for term in set(words(text)):
                df = sum(1 for _, w in lists if term in w)
                tf = found.count(term)
                if tf:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
                    m = 10 + 90 * len(found) * count // total
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def check(spark, docs, queries, top=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(queries, "item_id long, text string")
    got = sorted((tuple(r) for r in lexical_search.ranked(d, q, top).collect()), key=str)
    assert got == brute(docs, queries, top)
    return got


def corpus(seed, count, vocabulary):
    """Few words are frequent, most are rare."""
    rng = random.Random(seed)
    draw = lambda n: " ".join(f"w{int(vocabulary * rng.random() ** 4)}" for _ in range(n))
    docs = [(n, draw(rng.randrange(1, 60))) for n in range(count)]
    return docs, [(n, draw(rng.randrange(1, 12))) for n in range(15)]


@pytest.mark.parametrize("top", [1, 3, 10])
def test_equals_plain_version(spark, top, monkeypatch):
    monkeypatch.setattr(lexical_search, "RANGE", 16)
    docs, queries = corpus(top, 400, 300)
    check(spark, docs, queries, top)


def test_long_lists_alone_and_short_lists_alone(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "RANGE", 8)
    docs, queries = corpus(7, 200, 40)
    monkeypatch.setattr(lexical_search, "SHORT", 10**9)
    check(spark, docs, queries, 4)
    monkeypatch.setattr(lexical_search, "SHORT", 1)
    check(spark, docs, queries, 4)


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 20)
    monkeypatch.setattr(lexical_search, "SPLIT_CHARS", 300)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 25)
    docs, queries = corpus(8, 150, 60)
    check(spark, docs, queries, 5)


def test_ties_copies_nulls_and_long_text(spark):
    docs = [(n, "same words here") for n in range(40)] + [(None, "same words here"), (3, "same words here")]
    docs += [(50, None), (51, ""), (52, "!?"), (53, "Same É é " * 20_000), (54, "İ K words")]
    queries = [(1, "SAME"), (1, "same words"), (2, None), (3, "..."), (None, "é É"), (4, "absent"), (5, "k words words")]
    check(spark, docs, queries)


def test_empty_tables_and_clashing_names(spark):
    some = [(1, "a b")]
    assert check(spark, [], some) == [] and check(spark, some, []) == [] and check(spark, [(1, "?")], some) == []
    docs = spark.createDataFrame([("k", 0, "cat dog", "x")], "`d.id` string, rank int, `text` string, score string")
    queries = spark.createDataFrame([("cat", "q", 1)], "t string, doc string, query int")
    row = lexical_search.ranked(docs, queries, 2, "d.id", "text", "doc", "t").first()
    assert (row["item"], row["rank"], row["doc"]) == ("q", 1, "k")


def test_query_matches_sql(spark):
    sf, name = "/root/testdata/sf0.01", "op13_lexical_search"
    with compare.connect(sf) as connection:
        assert compare.differences(registered()[name](spark, sf), connection, statements()[name]) is None
