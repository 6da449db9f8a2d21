import hashlib
import random
import sys

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from barlake.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(spark, library, texts):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string").coalesce(2)
    out = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert len(out) == len(texts)
    for row in out:
        text = texts[row["n"]]
        assert row["ids"] == library.encode_ordinary(text or ""), (text or "")[:60]
        assert bytes(row["decoded"]) == (text or "").encode()


def test_every_character(spark, library):
    every = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    same(spark, library, ["".join(every[i : i + 2000]) for i in range(0, len(every), 2000)])


def test_random_texts(spark, library):
    rng = random.Random(3)
    kinds = ["ab c'slt1  \n\t.!é \u0085　\x1c", "etaoin shrdlu", "aab", "的一是不了 。", "<|endoftext|> \U0001f600"]
    same(spark, library, ["".join(rng.choices(k, k=rng.randrange(80))) for k in kinds for _ in range(200)])


def test_nulls_empty_long_and_repeated(spark, library):
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefgh", k=30_000))
    edge = ["x" * n for n in (1, 2, 255, 256, 257, 5000)] + ["".join(rng.choices("abcdeé", k=n)) for n in (254, 255, 256, 257)]
    same(spark, library, [None, "", " ", "the", "the", "the " * 5000, long, long, "\n" * 3000, *edge])


def test_long_words_merge_like_the_fold(library):
    rng = random.Random(5)
    ranks = byte_bpe.read_ranks(PATH)
    for _ in range(300):
        word = "".join(rng.choices("etaoinsé", k=rng.randrange(1, 60)))
        assert byte_bpe.merge_long(word.encode(), ranks) == [
            i for i in library._encode_single_piece(word) or []
        ]


def test_small_chunks(spark, library, monkeypatch):
    texts = [f"some words of text {n} {'again ' * (n % 7)}" for n in range(300)]
    monkeypatch.setattr(byte_bpe, "CHUNK_CHARS", 500)
    monkeypatch.setattr(byte_bpe, "SPLIT_CHARS", 100)
    monkeypatch.setattr(byte_bpe, "OUT_ROWS", 3)
    monkeypatch.setattr(byte_bpe, "LONG_BYTES", 5)
    same(spark, library, texts)
    monkeypatch.setattr(byte_bpe, "WORDS", 50)
    same(spark, library, texts)


def test_columns_and_odd_ids(spark, library):
    docs = spark.createDataFrame([Row(**{"ids": "old", "words": 1, "a.b": [1.5], "text": "The cat"})])
    out = byte_bpe.encode(docs, PATH, PATTERN)
    assert out.columns == ["words", "a.b", "text", "ids"]
    assert out.first()["ids"] == library.encode_ordinary("The cat") and out.first()["a.b"] == [1.5]
    alone = byte_bpe.encode(docs.select("text"), PATH, PATTERN, keep_text=False)
    assert alone.columns == ["ids"] and alone.first()["ids"] == library.encode_ordinary("The cat")
    assert byte_bpe.encode(docs.limit(0), PATH, PATTERN).collect() == []
    ids = spark.createDataFrame([([10**6, *library.encode_ordinary("cat"), None, -1], "old"), (None, "x")], "ids array<int>, decoded string")
    assert [r["decoded"] and bytes(r["decoded"]) for r in byte_bpe.decode(ids, PATH).collect()] == [b"cat", None]


def test_map_is_one_literal(spark):
    docs = spark.createDataFrame([("x",)], "text string")
    plan = byte_bpe.encode(docs, PATH, PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "Exchange" not in plan


def test_vocabulary_without_a_byte(tmp_path):
    file = tmp_path / "ranks"
    file.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(file))


def test_query(spark, library):
    from barlake.llm.queries import registered

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in registered()["op11_byte_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids, row = library.encode_ordinary(doc["text"] or ""), got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


def test_memory_of_numbering_does_not_grow_with_the_batch():
    import tracemalloc

    import pyarrow as pa
    import regex

    texts = [f"the cat and the dog of text {n % 90} " * 300 for n in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(texts)], ["n", "text"])
    size = sum(map(len, texts))
    del texts
    chunk = byte_bpe.Numbering(byte_bpe.read_ranks(PATH), regex.compile(PATTERN))
    tracemalloc.start()
    # All texts decoded at once take twice the batch.
    rows = [(row.num_rows, len(row["rows"][0]), row.nbytes) for row in byte_bpe.chunk_rows(iter([batch]), chunk)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for _, n, _ in rows) == 1500 and not chunk.parts
    assert peak < size and max(n for _, _, n in rows) < size / 4, (peak, size)


def test_fold_copies_no_arrays_for_short_words(spark):
    docs = spark.createDataFrame([("x",)], "text string")
    plan = byte_bpe.encode(docs, PATH, PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    # The fold took most of the CPU seconds with two slices and a lookup in a map of pairs for every merge.
    assert "aggregate" in plan and not any(word in plan for word in ("flatten", "slice", "element_at"))


def test_words_about_the_size_of_the_number(spark, library):
    rng = random.Random(6)
    kinds = ["etaoinsh", "aab", "的一是不了", "éèe", "=-"]
    same(spark, library, ["".join(rng.choices(k, k=n)) for k in kinds for n in (6, 7, 18, 19, 20, 21, 22, 40, 63, 64, 65, 85) for _ in range(9)])


def test_any_ranks(spark, tmp_path):
    import base64

    rng = random.Random(7)
    for n in range(3):
        # Most tokens cannot be reached by merging, and many rank below their parts.
        tokens = list({"".join(rng.choices("abc", k=rng.randrange(2, 6))).encode() for _ in range(40)} | {b"ab", b"abc"})
        rng.shuffle(tokens)
        path = tmp_path / f"ranks{n}"
        path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([*(bytes([b]) for b in range(256)), *tokens])))
        ranks = byte_bpe.read_ranks(str(path))
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choices("aabbc ", k=rng.randrange(60))) for _ in range(200)]
        docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
        for row in byte_bpe.encode(docs, str(path), PATTERN).collect():
            assert row["ids"] == own.encode_ordinary(row["text"])


def test_splitter_cuts_like_the_pattern():
    import regex

    rng, split, cut = random.Random(8), regex.compile(PATTERN), byte_bpe.Splitter().split
    kinds = ["' rstvemld", "'a1 \n", " \t\n.'s", "'rele vdé1\u00a0\u2003\u3000x.", "'llrevestm\U0001f600"]
    for kind in kinds:
        for _ in range(40):
            texts = ["".join(rng.choices(kind, k=rng.randrange(14))) for _ in range(60)]
            pieces, counts = cut(texts)
            wanted = [split.findall(text) for text in texts]
            assert counts.tolist() == [len(w) for w in wanted]
            assert pieces.to_pylist() == [p for w in wanted for p in w]
    assert [part.tolist() if i else part.to_pylist() for i, part in enumerate(cut(["", ""]))] == [[], [0, 0]]
    assert len(cut([])[0]) == 0


def test_tables_of_the_vocabulary_are_small():
    import tracemalloc

    ranks = byte_bpe.read_ranks(PATH)
    tracemalloc.start()
    tokens = byte_bpe.Tokens(ranks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tokens.bases) < 4 * len(ranks) and peak < 100_000_000, (len(tokens.bases), peak)
