"""Token-id files: one compressed wavelet matrix per shard, in document order (operator 4).

Documents are range-partitioned and sorted by id. Each task encodes its range into shards of
about ``SHARD_TOKENS`` tokens, so its memory does not depend on the size of a range. A shard is one compressed
file: the documents' ids and lengths, then the wavelet matrix of all their tokens. Spark itself stores the
shards, as binary values of a Parquet table: any path that Spark knows will do, and its commit
protocol keeps what a lost executor wrote out of the table. ``token_counts`` and ``token_places`` look tokens up
in the stored shards by rank and select, without spelling out the sequence.

Texts are cut at ASCII white space, which no token spans, and between letters and signs; the tokenizers
library encodes each distinct piece once. Nulls are empty texts with the end id alone. Rows that repeat an id follow each
other in the order of their texts; rows without id come first.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.text import chunks, column, utf8
from barlake.llm.wavelet import WaveletMatrix
from barlake.storage import has_files

SHARD_TOKENS = 2_000_000
CHUNK_BYTES = 4_000_000
CACHE_PIECES = 1_000_000
JOINED_PIECES = 2_000
# Bytes of shards that a reader holds at once.
ROW_GROUP = 16 << 20


# Classes of bytes: white space, letters, other ASCII, the apostrophe, beyond ASCII.
SPACE, LETTER, SIGN, APOSTROPHE, BEYOND = range(5)
# What the cuts between letters and signs rely on; other vocabularies are cut at white space alone.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of a-z and the letters from U+00C0 to U+00FF, in any case: all are composed already.
WORD = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_classes() -> np.ndarray:
    out = np.full(256, BEYOND, np.uint8)
    out[:128] = [SPACE if bytes([c]).isspace() else LETTER if bytes([c]).isalpha() else SIGN for c in range(128)]
    out[ord("'")] = APOSTROPHE
    return out


def _edges(words: bool) -> tuple[np.ndarray, np.ndarray]:
    """By the classes of two neighbours (5 * first + second): whether a piece begins, or ends, between them."""
    first, second = np.divmod(np.arange(25), 5)
    sign = (first == SIGN) | (first == APOSTROPHE), (second == SIGN) | (second == APOSTROPHE)
    # A run of letters ends before a sign, and begins after one, unless a contraction may have begun.
    cut = ((first == LETTER) & sign[1] | (first == SIGN) & (second == LETTER)) & words
    return (second != SPACE) & ((first == SPACE) | cut), (first != SPACE) & ((second == SPACE) | cut)


CLASSES, CUTS = _byte_classes(), {words: _edges(words) for words in (False, True)}


def _byte_symbols() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return dict(zip(shown, map(chr, shown), strict=True)) | {b: chr(256 + n) for n, b in enumerate(hidden)}


class PieceEncoder:
    """Encodes texts with the tokenizers library, remembering pieces.

    Pieces lie between white space; where the vocabulary's pattern is ``WORDS``, they also end where a run
    of letters does. A piece of letters alone is one word of the pattern, so its lower case goes right to the
    library's model; all others go through the whole of the library.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.levels = max(1, (max(self.tokenizer.get_vocab(with_added_tokens=True).values())).bit_length())
        known = json.loads(content)
        self.added = [token["content"].encode() for token in known.get("added_tokens", [])]
        steps = (known.get("normalizer") or {}).get("normalizers", [])
        cuts = (known.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.words = (
            [step["type"] for step in steps] == NORMALIZERS
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
            and (cuts[0]["pattern"], cuts[0]["invert"]) == ({"Regex": WORDS}, True)
            and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"]
        )
        self.model, self.symbols = self.tokenizer.model, _byte_symbols()
        self.forget()

    def forget(self) -> None:
        # The ids of a piece are those between two ends.
        self.numbers: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q")
        # The ids of lower-cased words, and of the pieces that are to be numbered.
        self.lower: dict[bytes, bytes] = {}
        self.cache: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces as one text, with a space between them, and cut the ids by their places.

        Where normalisation changes one of them, or one may hold an added token, they go alone.
        """
        text = b" ".join(pieces).decode("utf-8", "replace")
        if not self._plain(text):
            if len(pieces) > 16:
                half = len(pieces) // 2
                self._learn(pieces[:half])
                self._learn(pieces[half:])
                return
            alone = [p.decode("utf-8", "replace") for p in pieces]
            encoded = self.tokenizer.encode_batch(alone, add_special_tokens=False)
            self.cache.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(pieces, encoded, strict=True))
            return
        found = self.tokenizer.encode(text, add_special_tokens=False)
        sizes = map(len, pieces if text.isascii() else text.split(" "))
        lengths = np.fromiter(sizes, np.int64, len(pieces)) + 1
        starts = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
        counts = np.bincount(np.searchsorted(np.cumsum(lengths), starts, side="right"), minlength=len(pieces))
        raw, ends = np.array(found.ids, "<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        self.cache.update(zip(pieces, (raw[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)), strict=True))

    @staticmethod
    def _plain(text: str) -> bool:
        """Normalisation moves no place in it, and it holds no added token."""
        return "<|" not in text and text.isprintable() and (text.isascii() or unicodedata.is_normalized("NFC", text))

    def _words(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of pieces of ``WORD``."""
        lower = b" ".join(words).decode().lower().encode().split(b" ")
        new = [word for word in dict.fromkeys(lower) if word not in self.lower]
        # A space is written as a symbol, too, and no word holds one.
        symbols = b" ".join(new).decode("latin-1").translate(self.symbols).split(self.symbols[ord(" ")])
        tokenize = self.model.tokenize
        for word, text in zip(new, symbols if new else [], strict=True):
            self.lower[word] = array("I", [token.id for token in tokenize(text)]).tobytes()
        return map(self.lower.__getitem__, lower if words else [])

    def _store(self, pieces: list[bytes], ids: list[bytes]) -> int:
        """Number new pieces one after the other; returns the first number."""
        first = len(self.ends)
        self.numbers.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.ends.extend((np.cumsum([len(i) // 4 for i in ids]) + len(self.ids)).tolist())
        self.ids.frombytes(b"".join(ids))
        return first

    def _number(self, pieces: list[bytes], words: bool) -> int:
        """Encode and number new pieces."""
        plain = list(filter(WORD.fullmatch, pieces)) if words else []
        self.cache = dict(zip(plain, self._words(plain), strict=True))
        rest = [piece for piece in pieces if piece not in self.cache]
        for lo in range(0, len(rest), JOINED_PIECES):
            self._learn(rest[lo : lo + JOINED_PIECES])
        return self._store(pieces, [self.cache[piece] for piece in pieces])

    def _pieces(self, data: bytes, words: bool) -> tuple[np.ndarray, pa.Array]:
        """Where the pieces of ``data`` begin, and the pieces."""
        raw = np.frombuffer(data, np.uint8)
        kinds = CLASSES[raw]
        if words:
            lead = np.flatnonzero(raw == 0xC3)
            lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
            kinds[lead] = kinds[lead + 1] = LETTER
        pairs = np.concatenate(([SPACE], kinds)) * np.uint8(5) + np.concatenate((kinds, [SPACE]))
        begins, ends = (np.flatnonzero(edge[pairs]) for edge in CUTS[words])
        offsets = np.zeros(len(begins) + 1, np.int32)
        np.cumsum(ends - begins, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[kinds != SPACE])]
        return begins, pa.Array.from_buffers(pa.binary(), len(begins), buffers)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by the end id, and the number of each text's ids."""
        data = b" ".join((*texts, b""))
        words = self.words and not any(token in data for token in self.added)
        begins, pieces = self._pieces(data, words)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.numbers) > CACHE_PIECES:
            self.forget()
        # White space is no piece, so this one stands for the end of a text.
        end = self.numbers.get(b" ")
        if end is None:
            end = self._store([b" "], [np.array([end_id], "<u4").tobytes()])
        numbers = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(len(new)) + self._number([distinct[i] for i in new.tolist()], words)
        numbers = numbers[coded.indices.to_numpy()]
        bounds = np.searchsorted(begins, np.cumsum([len(text) + 1 for text in texts]))
        numbers = np.insert(numbers, bounds, end)
        ids, ends = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        lasts = ends[numbers]
        taken = lasts - np.where(numbers > 0, ends[numbers - 1], 0)
        upto = np.cumsum(taken)
        out = ids[np.repeat(lasts - upto, taken) + np.arange(upto[-1] if len(upto) else 0)]
        stops = upto[bounds + np.arange(len(texts))] if len(texts) else np.zeros(0, np.int64)
        return out, np.diff(stops, prepend=0)


@lru_cache(maxsize=2)
def _encoder(content: bytes) -> PieceEncoder:
    return PieceEncoder(content)


def pack_shard(keys: pa.Array, counts: np.ndarray, ids: np.ndarray, levels: int) -> bytes:
    """A shard file: the length of the document index, the index as an Arrow stream, the matrix."""
    index = pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], ["key", "n_tokens"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, index.schema) as writer:
        writer.write_batch(index)
    head = sink.getvalue().to_pybytes()
    kind = np.uint16 if levels <= 16 else np.uint32
    return struct.pack("<Q", len(head)) + head + WaveletMatrix.build(ids.astype(kind), levels).to_bytes()


def unpack_shard(content: bytes) -> tuple[pa.Array, np.ndarray, WaveletMatrix]:
    """Keys, numbers of tokens, and the tokens of a shard file."""
    size = struct.unpack_from("<Q", content)[0]
    index = pa.ipc.open_stream(content[8 : 8 + size]).read_all().combine_chunks()
    keys = index["key"].chunk(0) if index["key"].num_chunks else pa.array([], index["key"].type)
    return keys, index["n_tokens"].to_numpy(), WaveletMatrix.from_bytes(content[8 + size :])


STORED = "part int, shard int, n_docs long, n_tokens long, content binary"
MANIFEST = ["part", "shard", "n_docs", "n_tokens"]


def write_shards(
    docs: DataFrame,
    vocabulary: str,
    folder: str,
    end_id: int = 2,
    key_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the shards to ``folder``, which must hold none yet; returns the manifest.

    ``part`` and ``shard`` order the shards.
    """
    spark = docs.sparkSession
    if has_files(spark, folder):
        raise FileExistsError(f"{folder} holds files already")
    with open(vocabulary, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(column(key_col).alias("key"), column(text_col).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        part = TaskContext.get().partitionId()
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        shard = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard
            keys = pa.concat_arrays([k for k, _, _ in held])
            counts, ids = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            row = [[part], [shard], [len(keys)], [len(ids)], [pack_shard(keys, counts, ids, encoder.levels)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            shard += 1
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], [*MANIFEST, "content"]
            )

        for batch in batches:
            texts = utf8(batch["text"])
            for lo, hi in chunks([len(t) for t in texts], CHUNK_BYTES):
                ids, counts = encoder.encode(texts[lo:hi], end_id)
                held.append((batch["key"].slice(lo, hi - lo), counts, ids))
                if sum(len(h[2]) for h in held) >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    # Shards are compressed already; one is a page, and a few are a row group.
    stored = ordered.mapInArrow(run, STORED).write.option("compression", "none").option("parquet.block.size", ROW_GROUP)
    stored.mode("append").parquet(folder)
    return spark.read.schema(STORED).parquet(folder).select(*MANIFEST)


def _shards(manifest: DataFrame, folder: str) -> DataFrame:
    return manifest.sparkSession.read.schema(STORED).parquet(folder)


def _starts(manifest: DataFrame) -> DataFrame:
    """How many tokens stand before each shard."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per partition of the write, whatever the size of the data.
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    placed = manifest.withColumn("inside", inside).join(before, "part")
    return placed.select("part", "shard", (F.col("before") + F.col("inside")).alias("start"))


def read_shards(manifest: DataFrame, folder: str, key: str = "long") -> DataFrame:
    """Per document: ``key``, ``start`` (tokens of all documents before it), ``n_tokens`` and ``ids``,
    little-endian 32-bit integers, all of it from the files."""
    placed = _shards(manifest, folder).join(_starts(manifest), ["part", "shard"]).select("start", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, start in zip(batch["content"], batch["start"].to_pylist(), strict=True):
                keys, counts, matrix = unpack_shard(content.as_py())
                ids = matrix.values().astype("<u4")
                ends = np.cumsum(counts)
                raw = ids.tobytes()
                values = [raw[a:b] for a, b in zip((4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(values, pa.binary())],
                    ["key", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(run, f"key {key}, start long, n_tokens long, ids binary")


def token_counts(manifest: DataFrame, folder: str, tokens: list[int]) -> DataFrame:
    """``token`` and ``occurrences`` in all shards, counted by rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                matrix = unpack_shard(content.as_py())[2]
                counts = [matrix.count(token) for token in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.int32()), pa.array(counts, pa.int64())], ["token", "n"]
                )

    found = _shards(manifest, folder).select("content").mapInArrow(run, "token int, n long")
    return found.groupBy("token").agg(F.sum("n").alias("occurrences"))


def token_places(manifest: DataFrame, folder: str, token: int, key: str = "long") -> DataFrame:
    """``place`` (tokens before it in all shards) and ``key`` (its document) of every occurrence, by select."""
    placed = _shards(manifest, folder).join(_starts(manifest), ["part", "shard"]).select("start", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, start in zip(batch["content"], batch["start"].to_pylist(), strict=True):
                keys, counts, matrix = unpack_shard(content.as_py())
                places = np.array(matrix.places(token), np.int64)
                owners = np.searchsorted(np.cumsum(counts), places, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places + start), keys.take(pa.array(owners))], ["place", "key"]
                )

    return placed.mapInArrow(run, f"place long, key {key}")
