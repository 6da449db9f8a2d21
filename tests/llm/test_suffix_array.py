import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import repeats
from barlake.llm import suffix_array as sa
from barlake.llm.queries import registered


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        marks = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                marks[i : i + length] = [True] * length
        out.append(bytes(x for x, m in zip(b, marks, strict=True) if not m))
    return out


def got(spark, texts, length, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = sa.repeated_spans(docs, length, **more)
    keys = repeats.keyed(docs, "doc_id", "text")
    rows = keys.join(spans, ["t1", "t2"], "left").collect()
    kept = {r["id"]: r["text"].encode() if r["kept"] is None else bytes(r["kept"]) for r in rows}
    return [kept[i] for i in range(len(texts))]


def odd_texts(seed):
    rng = random.Random(seed)
    base = "".join(rng.choices("abcdefgh", k=400))
    texts = [None, "", "short", "ab" * 200, "ba" * 150, "a" * 500, "a" * 30, base, base, base[:150] + "X" + base[150:]]
    texts += ["".join(rng.choices("ab", k=rng.randint(10, 200))) for _ in range(40)]
    texts += ["é" * 60 + base[100:160] + "ü", "é" * 61, base[37:300] * 2]
    return texts


def test_matches_brute_force(spark):
    texts = odd_texts(1)
    assert got(spark, texts, 24, gram=8) == brute(texts, 24)


def test_hot_anchors_take_the_other_way(spark):
    texts = odd_texts(2)
    assert got(spark, texts, 24, gram=8, hot=3) == brute(texts, 24)


def test_many_blocks_and_buckets(spark, monkeypatch):
    texts = odd_texts(3)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2000)
    assert got(spark, texts, 24, gram=8) == brute(texts, 24)
    rng = random.Random(4)
    passages = list({bytes(rng.choices(b"ab", k=rng.randint(40, 90))) for _ in range(60)})
    monkeypatch.setattr(sa, "BUCKET_SUFFIXES", 50)
    found = sa.repeated_windows(passages, [rng.randint(0, 5) for _ in passages], 40)
    count = {}
    for p in passages:
        for i in range(len(p) - 39):
            count[p[i : i + 40]] = count.get(p[i : i + 40], 0) + 1
    for p, marks in zip(passages, found, strict=True):
        assert marks.tolist() == [count[p[i : i + 40]] > 1 for i in range(len(p) - 39)]


def test_difference_cover():
    differences = {(a - b) % sa.PERIOD for a in sa.COVER for b in sa.COVER if a != b}
    assert len(differences) == sa.PERIOD - 1


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcdefghijkl"])
def test_sorter_orders_suffixes(alphabet):
    rng = random.Random(5)
    text = bytes(rng.choices(alphabet, k=700))
    starts = np.arange(len(text))
    ordered = np.concatenate(list(sa.SuffixSorter(text, 100).buckets(starts)))
    padded = text + bytes(200)
    assert [padded[i : i + 100] for i in ordered] == sorted(padded[i : i + 100] for i in starts)


def test_anchors_cover_each_window_once(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    whole = repeats.byte_grams(data, 8)
    monkeypatch.setattr(repeats, "_SPAN", 256)
    assert (repeats.byte_grams(data, 8) == whole).all()
    places, first, last = repeats.anchors(whole, 17)
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    assert windows.tolist() == list(range(len(whole) - 16))
    assert ((places >= last) & (places <= first + 16)).all()


def test_documents_keep_rows_and_columns(spark):
    base = "".join(random.Random(6).choices("abcdefgh", k=300))
    rows = [(1, base + "é tail", 1), (2, "é" + base, 2), (3, None, 3), (1, "plain", 4), (1, "plain", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t1 int").withColumn("starts", F.lit("x"))
    out = {r["t1"]: r["text"] for r in sa.remove_repeats(docs).collect()}
    assert out == {1: "é tail", 2: "é", 3: None, 4: "plain", 5: "plain"}
    assert sa.remove_repeats(docs).columns == docs.columns
    assert sa.remove_repeats(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    wanted = brute([d["text"] for d in docs], 200)
    rows = {r["doc_id"]: r for r in registered()["op9_suffix_array"](spark, sf).collect()}
    assert len(rows) == len(docs)
    for doc, kept in zip(docs, wanted, strict=True):
        row = rows[doc["doc_id"]]
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert row["n_bytes"] - row["n_removed"] == len(kept)
