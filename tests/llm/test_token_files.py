import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlake.llm import token_files as tf
from barlake.llm.queries import registered
from barlake.llm.scratch import Scratch
from barlake.llm.wavelet import WaveletMatrix

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for size, levels in [(0, 3), (1, 1), (1500, 4), (3000, 16)]:
        values = rng.integers(0, 1 << levels, size)
        values[size // 2 :] %= 3
        matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(values.astype(np.uint16), levels).to_bytes())
        assert matrix.values().tolist() == values.tolist()
        for place in rng.integers(0, max(size, 1), 20 if size else 0).tolist():
            assert matrix[place] == values[place]
            assert matrix.rank(int(values[place]), place) == (values[:place] == values[place]).sum()
        for value in [0, 1, 2, (1 << levels) - 1, 1 << levels]:
            assert matrix.count(value) == (values == value).sum()
        for value in [1, int(values[0]) if size else 0]:
            assert matrix.places(value)[:40] == np.flatnonzero(values == value).tolist()[:40]
    with pytest.raises(IndexError):
        matrix.select(1, 10**6)


def test_pieces_encode_as_whole_texts(library):
    with open(PATH, "rb") as file:
        encoder = tf.PieceEncoder(file.read())
    every = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(every[i : i + 300]) for i in range(0, len(every), 300)]
    rng = random.Random(1)
    texts += ["".join(rng.choices("abE é́'sT1\n \u0085 \x1c.Σ<|endoftext|>", k=80)) for _ in range(400)]
    texts += ["", " ", "a<|endoftext|>b <|startoftext|>", "e ́", "ΑΣ ΑΣ."]
    ids, counts = encoder.encode([t.encode() for t in texts], 2)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, part, want in zip(texts, parts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert part.tolist() == [*want.ids, 2], text


def test_words_and_signs_are_pieces_of_their_own(library):
    with open(PATH, "rb") as file:
        content = file.read()
    texts = ["The cat's hat, the CAT; (hat)", "Été! été? ÉTÉ", "don't 'stop 't 'élan x.'s", "a×b÷c e\u0331h́ H\u0331 h\u0331", "a1b2"]
    encoder = tf.PieceEncoder(content)
    ids, _ = encoder.encode([t.encode() for t in texts], 2)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert ids.tolist() == [i for e in want for i in (*e.ids, 2)]
    assert {b"hat", b",", b"(", b"cat", "Été".encode(), b"!"} <= set(encoder.numbers) and b"hat," not in encoder.numbers
    # Another pattern, whose pieces go on over signs: cut at white space alone.
    other = tf.PieceEncoder(content.replace(rb"[^\\s\\p{L}\\p{N}]+", rb"[^\\s\\p{L}\\p{N}]{2}"))
    assert encoder.words and not other.words
    ids, _ = other.encode([texts[0].encode()], 2)
    assert ids.tolist() == [*other.tokenizer.encode(texts[0], add_special_tokens=False).ids, 2]
    assert b"hat," in other.numbers


def test_files_round_trip_in_order(spark, folder, library, monkeypatch):
    monkeypatch.setattr(tf, "CHUNK_BYTES", 30)
    rows = [Row(doc_id=i * 7 % 101, text=f"Word {i} text" * (i % 5)) for i in range(101)]
    rows += [Row(doc_id=5, text="again"), Row(doc_id=300, text=None)]
    docs = spark.createDataFrame(rows).withColumns({"key": F.lit("x"), "part": F.lit(1)})
    manifest = Scratch(spark).result(tf.write_shards(docs, PATH, folder, shard_tokens=50), "manifest")
    assert manifest.filter("n_tokens > 2000").isEmpty() and manifest.count() > 5
    got = sorted(tf.read_shards(manifest, folder).collect(), key=lambda r: r["start"])
    wanted, start = sorted(rows, key=lambda r: (r["doc_id"], r["text"] or "")), 0
    for row, want in zip(got, wanted, strict=True):
        ids = [*library.encode(want["text"] or "").ids, 2]
        assert (row["key"], row["start"], row["n_tokens"]) == (want["doc_id"], start, len(ids))
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == ids
        start += len(ids)


def test_empty_table(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = tf.write_shards(docs, PATH, folder)
    assert tf.read_shards(manifest, folder).collect() == []


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in registered()["op4_token_files"](spark, sf).collect()}
    start = 0
    for doc in docs:
        ids = [*library.encode(doc["text"] or "", add_special_tokens=False).ids, 2]
        assert got[doc["doc_id"]] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_lookups_in_stored_shards(spark, folder, library, monkeypatch):
    monkeypatch.setattr(tf, "CHUNK_BYTES", 30)
    rows = [Row(doc_id=i, text=f"word {i % 7} the word " * (i % 4)) for i in range(60)]
    docs = spark.createDataFrame(rows)
    manifest = tf.write_shards(docs, PATH, f"{folder}/shards", shard_tokens=40)
    assert manifest.count() > 3
    flat, owners = [], []
    for row in rows:
        ids = [*library.encode(row["text"]).ids, 2]
        flat += ids
        owners += [row["doc_id"]] * len(ids)
    wanted = {t: flat.count(t) for t in {*flat[:20], 2, 40_000}}
    got = {r["token"]: r["occurrences"] for r in tf.token_counts(manifest, f"{folder}/shards", list(wanted)).collect()}
    assert got == wanted
    for token in (flat[5], 2, 40_000):
        places = sorted((r["place"], r["key"]) for r in tf.token_places(manifest, f"{folder}/shards", token).collect())
        assert places == [(n, owners[n]) for n, t in enumerate(flat) if t == token]
    with pytest.raises(FileExistsError):
        tf.write_shards(docs, PATH, f"{folder}/shards")


def test_a_path_that_only_spark_knows_and_other_keys(spark, folder):
    """viewfs paths exist for Hadoop's file systems alone."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tokens.link./out", f"file://{folder}")
    docs = spark.createDataFrame([Row(name="b", text="one two"), Row(name="a", text=None), Row(name=None, text="x")])
    where = "viewfs://tokens/out/shards"
    manifest = tf.write_shards(docs, PATH, where, key_col="name")
    got = sorted(tf.read_shards(manifest, where, key="string").collect(), key=lambda r: r["start"])
    assert [(r["key"], r["n_tokens"]) for r in got] == [(None, 2), ("a", 1), ("b", 3)]
