import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from barlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read())


def same(model, library, texts):
    ids, counts = model.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    wanted = library.encode_batch(texts, add_special_tokens=False)
    for text, got, want in zip(texts, parts, wanted, strict=True):
        assert got.tolist() == want.ids, text[:50]
    back = model.decode(ids.astype(np.int64), counts)
    assert back == [library.decode(w.ids, skip_special_tokens=False) for w in wanted]


def test_every_character(model, library):
    every = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    rng = random.Random(1)
    same(model, library, ["".join(every[i : i + 500]) for i in range(0, len(every), 500)])
    for _ in range(20):
        same(model, library, ["".join(rng.choices("ab c'slt1  \n\t.!é \u0085　\x1c", k=60)) for _ in range(50)])


def test_special_runs_and_long_words(model, library):
    rng = random.Random(2)
    texts = ["", " ", "a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "aaaaaaaaaaa" * 50, "<|endoftex"]
    texts.append("".join(rng.choices("abcdefgh", k=30_000)))
    texts += ["the " * 400, "\n\n\n  \n", "É" * 1000, "x" * 7 + " " * 9 + "y"]
    same(model, library, texts)


def test_frames(spark, library):
    rows = [Row(a=1, text="The cat"), Row(a=2, text=None), Row(a=3, text=""), Row(a=3, text="The cat")]
    docs = spark.createDataFrame(rows)
    for packed in (True, False):
        out = bpe.decode(bpe.encode(docs, PATH, packed=packed), PATH, packed=packed).orderBy("a").collect()
        assert [r["decoded"] for r in out] == ["The cat", "", "", "The cat"]
        ids = out[0]["ids"]
        ids = np.frombuffer(bytes(ids), "<u4").tolist() if packed else ids
        assert ids == library.encode("The cat").ids


def test_ids_out_of_range_and_clashing_names(spark):
    ids = spark.createDataFrame([Row(ids=[464, 10**6, 3797], decoded="old")])
    assert bpe.decode(ids, PATH).collect() == [Row(ids=[464, 10**6, 3797], decoded="The cat")]
    docs = spark.createDataFrame([Row(**{"ids": "old", "text": "The"})])
    assert bpe.encode(docs, PATH).first()["ids"] == [464]
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_query(spark, library):
    from barlake.llm.queries import registered

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in registered()["op3_bpe_round_trip"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
