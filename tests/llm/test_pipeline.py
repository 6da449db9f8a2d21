import hashlib
import random
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from brute_quality import verdicts
from tokenizers import Tokenizer

import corpus_pipeline
from barlake.llm.queries import registered
from barlake.llm.quality_rules import judge
from barlake.session import shared_dir

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    item = [word() for _ in range(14)]
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(260):
        words = [word() for _ in range(rng.randint(60, 160))]
        if i % 20 == 1:
            words = [w + "##" for w in words]
        if i % 20 == 2:
            words = rng.choices(words[:4], k=90)
        if i % 20 == 3:
            words[7:7] = item
        if i % 20 == 4:
            words[5:5] = passage.split()
        if i % 20 == 5:
            words = words[:30]
        if i % 20 in (6, 7):
            words = rows[i - 6][1].split()
            words[3] = "changed" if i % 20 == 6 else words[3]
        rows.append((i, " ".join(words), "en" if i % 3 else "de", f"s{i % 2}", 0))
    rows += [(260, None, None, None, None), (261, "", "en", "s0", 0)]
    return rows, [(1, " ".join(item)), (2, None)]


def near_duplicates(docs):
    sets = {}
    for k, t in docs:
        w = t.encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(k, t) for k, t in docs if root(k) == k]


def without_repeats(docs, length=200):
    seen = {}
    data = [(k, t.encode()) for k, t in docs]
    for _, b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for k, b in data:
        marks = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                marks[i : i + length] = [True] * length
        text = bytes(x for x, m in zip(b, marks, strict=True) if not m).decode(errors="ignore")
        if text.strip(" \t\n\r\x0b\x0c"):
            out.append((k, text))
    return out


def clean(docs, items, size=10):
    grams = set()
    for _, t in items:
        w = ALNUM.findall((t or "").lower())
        grams |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return [(k, t) for k, t in docs if not any(tuple(w) in grams for w in windows(ALNUM.findall(t.lower()), size))]


def windows(w, size):
    return [w[i : i + size] for i in range(len(w) - size + 1)]


@pytest.fixture
def tables(spark, folder):
    docs, items = corpus()
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_matches_the_stages_one_by_one(spark, tables):
    rows, items = corpus()
    kept = verdicts([(t, lang, source) for _, t, lang, source, _ in rows])
    judged = {r["key"]: r["kept"] for r in judge(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert judged == {r[0]: k for r, k in zip(rows, kept, strict=True)}
    first = [(r[0], r[1]) for r, k in zip(rows, kept, strict=True) if k]
    second = near_duplicates(first)
    third = without_repeats(second)
    fourth = clean(third, items)
    assert len(rows) > len(first) > len(second) > 0 and len(third) > len(fourth)
    assert dict(second) != dict(third)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {}
    for k, t in fourth:
        ids = library.encode(t, add_special_tokens=False).ids
        wanted[k] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), True)
    before = set(Path(shared_dir(spark)).iterdir())
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, tables).collect()}
    assert got == wanted
    left = set(Path(shared_dir(spark)).iterdir()) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["pipeline-bpe"]


def test_the_last_stage_keeps_the_token_ids(spark, folder):
    texts = {1: "some words of a text", 2: "", 3: "é\U0001f600 x\n"}
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in texts.items()], COLUMNS)
    name, stage = corpus_pipeline.STAGES[-1]
    stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{folder}/{name}").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(r["ids"]).hexdigest())


def test_stages_return_the_columns_of_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").withColumnRenamed("source", "source")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), tables)
        assert (empty.columns, empty.dtypes) == (docs.columns, docs.dtypes)
        assert empty.collect() == []
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "suffix_array", "decontamination", "bpe",
    ]
    assert "pipeline" not in registered()
