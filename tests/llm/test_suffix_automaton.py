import hashlib
import random
import re
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from barlake.llm import repeats
from barlake.llm import suffix_automaton as sam
from barlake.llm.queries import registered
from barlake.llm.scratch import Scratch


def brute(docs, size):
    tokens = [(k, (t or "").encode().split()) for k, t in docs]
    earliest = {}
    for k, w in tokens:
        for i in range(len(w) - size + 1):
            g = tuple(w[i : i + size])
            if k is not None and k < earliest.get(g, k + 1):
                earliest[g] = k
    out = []
    for k, w in tokens:
        marks = [False] * len(w)
        for i in range(len(w) - size + 1):
            if k is not None and earliest[tuple(w[i : i + size])] < k:
                marks[i : i + size] = [True] * size
        kept = b" ".join(x for x, m in zip(w, marks, strict=True) if not m)
        out.append((k, len(w), sum(marks), kept.decode()))
    return sorted(out, key=str)


def got(spark, docs, size, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(map(tuple, sam.deduplicated(frame, size, **more).collect()), key=str)


def odd_docs(seed):
    rng = random.Random(seed)
    base = rng.choices("a b c d e f g h".split(), k=80)
    texts = [None, "", "one two", "x " * 50, "x " * 30, " ".join(base), "\t".join(base), " ".join(base), "x y " * 20]
    texts += [" ".join(base[:30] + ["new"] + base[30:]), " ".join(base[20:60]), "é " + " ".join(base[:9])]
    texts += [" ".join(rng.choices("ab", k=rng.randint(3, 60))) for _ in range(40)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    return [*docs, (None, " ".join(base)), (3, "x " * 50), (3, " ".join(base)), (2, "x y " * 20)]


def test_matches_brute_force(spark):
    docs = odd_docs(1)
    assert got(spark, docs, 6, gram=3) == brute(docs, 6)


def test_hot_anchors_take_the_other_way(spark):
    docs = odd_docs(2)
    assert got(spark, docs, 6, gram=3, hot=3) == brute(docs, 6)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1500)
    docs = odd_docs(3)
    assert got(spark, docs, 6, gram=3) == brute(docs, 6)


def test_automaton_owners():
    rng = random.Random(4)
    sequences = [rng.choices("ab", k=rng.randint(5, 40)) for _ in range(30)]
    automaton = sam.SuffixAutomaton()
    for n, s in enumerate(sequences):
        automaton.add(s, (n * 7) % 30)
    automaton.finish()
    for s in [*sequences, rng.choices("abc", k=60)]:
        want = []
        for i in range(len(s) - 4):
            w = s[i : i + 5]
            holders = [(n * 7) % 30 for n, t in enumerate(sequences) if any(t[j : j + 5] == w for j in range(len(t) - 4))]
            want.append(min(holders, default=sam.NOBODY))
        assert automaton.owners(s, 5) == want


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("t1", F.lit("x"))
    assert sorted(map(tuple, sam.deduplicated(docs).collect())) == [(1, 2, 0, "a b"), (2, 0, 0, "")]
    assert sam.deduplicated(docs.limit(0)).collect() == []


def test_digests_are_those_of_what_is_left(spark):
    docs = odd_docs(5)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sorted(map(tuple, sam.digests(frame, 6, gram=3).collect()), key=str)
    assert rows == sorted(((k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in brute(docs, 6)), key=str)


def test_texts_are_hashed_once(spark, monkeypatch):
    plans = {}
    table = Scratch.table

    def kept(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", kept)
    docs = odd_docs(6)
    assert got(spark, docs, 6, gram=3) == brute(docs, 6)
    assert "MapInArrow" not in plans["suspects"]


def test_anchors_are_sent_with_a_row_number(spark, monkeypatch):
    plans = {}
    table = Scratch.table

    def kept(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", kept)
    docs = odd_docs(8)
    assert got(spark, docs, 6, gram=3) == brute(docs, 6)
    beside = re.findall(r"Generate explode\(anchors#\d+\), (?:\[([^\]]*)\])?", plans["suspects"])
    assert beside and all("t1" not in columns and "t2" not in columns for columns in beside), beside


def test_anchors_go_before_passages_are_cut(spark):
    scratch = Scratch(spark)
    rows = repeats.keyed(spark.createDataFrame(odd_docs(7), "doc_id long, text string"), "doc_id", "text")
    texts = repeats.suspects(rows, repeats.Scheme(6, 3, True), scratch)
    folder = Path(urlparse(scratch.paths[0]).path).parent
    assert len(scratch.paths) == 1 and texts.count() > 0 and not list(folder.glob("*anchors*"))
    scratch.clear()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = {tuple(r) for r in registered()["op7_substring_dedup"](spark, sf).collect()}
    assert rows == {(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in brute(docs, 13)}
