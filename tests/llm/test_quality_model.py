import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import quality_model as qm
from barlake.llm.queries import registered


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(60)]
    docs, labels = [], []
    for i in range(n):
        text = " ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randint(5, 40)))
        if i % 9 == 8:
            text = " ".join(f"{rng.random():.9f}#{w}" for w in text.split())
        docs.append((i, text, "en" if i % 4 else None))
        if i % 3:
            labels.append((i, int(i % 9 != 8)))
    docs += [(n, None, "en"), (n + 1, "", "en"), (n + 2, "New words only", "xx"), (None, "no key", "en")]
    return docs, [*labels, (n, 1), (None, 1), (10**9, 1)]


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def training_ids(spark, docs, labels):
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    found = qm.trusted_rows(rows, labels, "doc_id", "quality")
    return {r["id"]: r["trusted"] for r in found.collect()}


def kneser_ney(texts, vocabulary):
    """The model from its formulas, over plain dictionaries; texts are lists of symbols."""
    pairs = collections.Counter(p for t in texts for p in zip(["<s>", *t], t, strict=False))

    def discount(times):
        n1, n2, n3, n4 = (sum(c == k for c in times) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return [0, 0.5, 1.0, 1.5]
        y = n1 / (n1 + 2 * n2)
        raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [0, *(min(max(d, 0.05), c - 0.05) for c, d in enumerate(raw, 1))]

    d = discount(pairs.values())
    before = collections.Counter(w for _, w in pairs)
    e = discount(before.values())
    kinds = len(pairs)
    freed = sum(e[min(3, c)] for c in before.values()) / kinds

    def lower(w):
        c = before.get(w, 0)
        return max(c - e[min(3, c)], 0) / kinds + freed / vocabulary

    def probability(v, w):
        after = [c for (a, _), c in pairs.items() if a == v]
        if not after:
            return lower(w)
        gamma = sum(d[min(3, c)] for c in after) / sum(after)
        c = pairs.get((v, w), 0)
        return max(c - d[min(3, c)], 0) / sum(after) + gamma * lower(w)

    return probability


def test_perplexities_match_the_formulas(spark):
    docs, labels = frames(spark, *corpus())
    trusted = training_ids(spark, docs, labels)
    texts = {r["doc_id"]: (r["text"] or "").encode().split() for r in docs.collect()}
    training = [texts[i] for i, t in trusted.items() if t == 1]
    counts = collections.Counter(w.lower() for t in training for w in t)
    known = {w for w, c in counts.items() if c > 1}

    def symbols(words):
        return [w.lower() if w.lower() in known else qm.shape(w) for w in words]

    probability = kneser_ney([symbols(t) for t in training], qm.FIRST_WORD + len(known))
    rows = qm.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        s = symbols(texts[r["id"]]) if r["id"] is not None else []
        if not s:
            assert (r["n_words"], r["perplexity"], r["kept"]) == (0, None, False)
            continue
        total = sum(math.log(probability(v, w)) for v, w in zip(["<s>", *s], s, strict=False))
        assert r["n_words"] == len(s)
        assert r["perplexity"] == pytest.approx(math.exp(-total / len(s)), rel=1e-9)
        assert r["kept"] == (r["perplexity"] <= r["threshold"])


def test_junk_goes_and_clean_text_stays(spark):
    rows = qm.classify(*frames(spark, *corpus(900))).collect()
    junk = {r["id"]: r["kept"] for r in rows if r["id"] is not None and r["id"] < 900 and r["id"] % 9 == 8}
    clean = {r["id"]: r["kept"] for r in rows if r["id"] is not None and r["id"] < 900 and r["id"] % 9 != 8}
    assert sum(junk.values()) == 0
    assert sum(clean.values()) > 0.98 * len(clean)


def test_thresholds_are_quantiles_of_the_held_out_documents(spark):
    values = [(i, 2 if i % 2 else 0, "a" if i < 200 else "b", math.log(i + 2)) for i in range(230)]
    scored = spark.createDataFrame(values, "id long, trusted int, language string, log_perplexity double")
    rows = {(r["every"], r["language"]): r for r in qm.thresholds(scored, 0.9, 50).collect()}
    assert set(rows) == {(False, "a"), (True, "")}
    held = sorted(v[3] for v in values if v[1] == 2 and v[2] == "a")
    assert 0 <= rows[(False, "a")]["threshold"] - held[math.ceil(0.9 * len(held)) - 1] <= 1 / 256


def test_documents_labelled_toxic_are_not_trusted(spark):
    rows = spark.range(100).select("id", F.lit("x").alias("text"))
    labels = [(i, 1, i % 3 == 0 and 1 or (0 if i % 3 == 1 else None)) for i in range(60)] + [(1, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["id"]: r["trusted"] for r in qm.trusted_rows(rows, labels, "doc_id", "quality", "toxic").collect()}
    assert {i for i, t in found.items() if t} == {i for i in range(60) if i % 3} - {1}


def test_small_languages_have_thresholds_of_their_own(spark):
    values = [(i, 2, "a", 1 + i / 1000) for i in range(1000)]
    values += [(1000 + i, 2, "b", 5 + i / 100) for i in range(3)]
    scored = spark.createDataFrame(values, "id long, trusted int, language string, log_perplexity double")
    rows = {(r["every"], r["language"]): r["threshold"] for r in qm.thresholds(scored, 0.99).collect()}
    every = sorted(v[3] for v in values)
    gap = every[math.ceil(0.99 * 1003) - 1] - every[math.ceil(0.75 * 1003) - 1]
    assert rows[(False, "b")] == pytest.approx(5.02 + gap, abs=3 / 256)
    assert rows[(False, "a")] == pytest.approx(1.989, abs=1 / 256)


def test_languages_without_trusted_text_are_kept(spark):
    docs, labels = corpus()
    rows = {r["id"]: r for r in qm.classify(*frames(spark, docs + [(9001, "never seen #1 #2", "yy")], labels)).collect()}
    assert rows[9001]["kept"] and rows[9001]["threshold"] == math.inf
    assert all(math.isfinite(r["threshold"]) for r in rows.values() if r["lang"] in ("en", None))


def test_without_trusted_text_and_with_empty_tables(spark):
    docs, labels = frames(spark, *corpus(30))
    rows = qm.classify(docs, labels.limit(0)).collect()
    assert all(r["kept"] == (r["n_words"] > 0) for r in rows)
    assert qm.classify(docs.limit(0), labels).collect() == []


def test_the_split_of_rows_and_many_shards_do_not_matter(spark, monkeypatch):
    docs, labels = frames(spark, *corpus(200))
    wide = docs.withColumns({"id": F.lit("x"), "trusted": F.lit(5)})
    first = {r["id"]: r["perplexity"] for r in qm.classify(docs, labels).collect()}
    monkeypatch.setattr(qm, "SHARD_BYTES", 1000)
    monkeypatch.setattr(qm, "BLOCK_BYTES", 500)
    again = {r["id"]: r["perplexity"] for r in qm.classify(wide.repartition(5), labels).collect()}
    assert first.keys() == again.keys()
    assert all(a == pytest.approx(again[k]) if a else again[k] is None for k, a in first.items())


def test_shapes_fit():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(33, 255, rng.integers(1, 40)).astype(np.uint8)) for _ in range(3000)]
    assert all(0 <= qm.shape(w) < qm.SHAPES for w in words)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = registered()["op1_quality_model"](spark, sf).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [r["kept"] for r in rows if quality.get(r["doc_id"]) == 1]
    junk = [r["kept"] for r in rows if quality.get(r["doc_id"]) == 0]
    assert len(rows) == 1000
    assert sum(clean) > 0.97 * len(clean) and sum(junk) < 0.5 * len(junk)
