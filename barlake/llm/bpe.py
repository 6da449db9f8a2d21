"""Byte-level BPE: encode texts to token ids and back (operator 3).

Texts are cut by the pre-tokeniser's pattern; the distinct words of a chunk of texts go through
the merges together. All their symbols lie in one flat array. In each round the keys of
neighbouring symbols are looked up by binary search in the sorted pair keys, every word
merges all places of its lowest-ranked pair, and words without a pair left drop out.

Nulls are encoded as the empty text, ids outside the vocabulary decode to nothing, and an
added token that stands in a text is one id. Columns besides the text pass through; an
output column that exists already is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barlake.llm.text import chunks, column, list_array

# Fixed value: the split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters of text whose words are merged together, and words that a task remembers.
CHUNK_CHARS = 1_000_000
CACHE_WORDS = 300_000

_NO_RANK = np.iinfo(np.int64).max


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(shifted)}


class Vocabulary:
    """Merges, symbols and token bytes of a tokenizer file, as arrays."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        to_byte = {c: b for b, c in byte_characters().items()}
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.symbols = np.array([vocab[c] for _, c in sorted(byte_characters().items())], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right, new = (
            np.array([vocab[x] for x in side], np.int64)
            for side in zip(*((a, b, a + b) for a, b in pairs), strict=True)
        )
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_ids = keys[order], order, new[order]
        token_bytes = [b""] * self.size
        for token, number in (vocab | self.added).items():
            known = all(c in to_byte for c in token)
            token_bytes[number] = bytes(to_byte[c] for c in token) if known else token.encode()
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.split = regex.compile(PATTERN)
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.cache: dict[str, bytes] = {}
        self._seed()

    def _seed(self) -> None:
        self.cache = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.split.findall(text)
        out = []
        for number, part in enumerate(self.special.split(text)):
            out += [part] if number % 2 else self.split.findall(part)
        return out

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.symbols[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            keys = symbols[:-1] * self.size + symbols[1:]
            places = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            found = (self.pair_keys[places] == keys) & (owner[:-1] == owner[1:])
            at = np.flatnonzero(found)
            if not len(at):
                break
            ranks, owners = self.pair_ranks[places[at]], owner[at]
            first = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
            best = np.repeat(
                np.minimum.reduceat(ranks, first), np.diff(np.concatenate((first, [len(at)])))
            )
            at = at[ranks == best]
            # Of places that overlap, as in a run of one symbol, take every second from the left.
            new_run = np.concatenate(([True], np.diff(at) != 1))
            begun = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begun) % 2 == 0]
            symbols[at] = self.pair_ids[places[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            active = np.zeros(len(words), bool)
            active[owners] = True
            live = active[owner]
            over = stay & ~live
            if over.any():
                done.append((owner[over], symbols[over]))
            stay &= live
            symbols, owner = symbols[stay], owner[stay]
        done.append((owner, symbols))
        owner = np.concatenate([o for o, _ in done])
        ids = np.concatenate([s for _, s in done])[np.argsort(owner, kind="stable")].astype("<u4")
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each."""
        parts = [self.pieces(text) for text in texts]
        flat = [piece for part in parts for piece in part]
        if not flat:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        coded = pa.array(flat, pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.cache) > CACHE_WORDS:
            self._seed()
        new = [piece for piece in distinct if piece not in self.cache]
        if new:
            self.cache.update(zip(new, self.merge([piece.encode() for piece in new]), strict=True))
        values = [self.cache[piece] for piece in distinct]
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        ids = np.frombuffer(b"".join(values), "<u4")
        starts = np.cumsum(lengths) - lengths
        indices = coded.indices.to_numpy()
        taken = lengths[indices]
        ends = np.cumsum(taken)
        out = ids[np.repeat(starts[indices] - ends + taken, taken) + np.arange(ends[-1])]
        upto = np.concatenate(([0], ends))
        bounds = upto[np.cumsum([0, *map(len, parts)])]
        return out, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids; bytes that are no UTF-8 become U+FFFD."""
        known = ids < self.size
        safe = np.where(known, ids, 0)
        taken = np.where(known, self.lengths[safe], 0)
        ends = np.cumsum(taken)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(self.starts[safe] - ends + taken, taken) + np.arange(total)].tobytes()
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)]


@lru_cache(maxsize=4)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _content(spark: SparkSession, path: str):
    """The vocabulary file, sent to the tasks; its size does not depend on the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _with(df: DataFrame, name: str, kind: T.DataType, dropped: list[str]) -> tuple[T.StructType, list[str]]:
    kept = [f for f in df.schema.fields if f.name != name and f.name not in dropped]
    return T.StructType([*kept, T.StructField(name, kind)]), [f.name for f in kept]


def encode(
    df: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "ids", packed: bool = False, keep_text: bool = True
) -> DataFrame:
    """Add the token ids of each text: ``array<int>``, or little-endian 32-bit ``binary`` if ``packed``."""
    content = _content(df.sparkSession, vocabulary)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema, kept = _with(df, out_col, kind, [] if keep_text else [text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _vocabulary(content.value)
        for batch in batches:
            texts = [t or "" for t in batch[text_col].to_pylist()]
            for lo, hi in chunks([len(t) for t in texts], CHUNK_CHARS):
                ids, counts = model.encode(texts[lo:hi])
                if packed:
                    raw, ends = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
                    values = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                    added = pa.array(values, pa.binary())
                else:
                    added = list_array(ids.astype(np.int32), counts, pa.int32())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part[n] for n in kept), added], [*kept, out_col])

    return df.select(*(column(n) for n in dict.fromkeys([*kept, text_col]))).mapInArrow(run, schema)


def decode(
    df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded", packed: bool = False
) -> DataFrame:
    """Add the text of each row's token ids (see ``encode``)."""
    content = _content(df.sparkSession, vocabulary)
    schema, kept = _with(df, out_col, T.StringType(), [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _vocabulary(content.value)
        for batch in batches:
            rows = batch[ids_col].to_pylist() if packed else None
            sizes = (
                [len(r or b"") // 4 for r in rows]
                if packed
                else [n or 0 for n in batch[ids_col].value_lengths().to_pylist()]
            )
            for lo, hi in chunks(sizes, CHUNK_CHARS // 2):
                if packed:
                    ids = np.frombuffer(b"".join(r or b"" for r in rows[lo:hi]), "<u4")
                else:
                    flat = batch[ids_col].slice(lo, hi - lo).flatten()
                    ids = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.uint32)
                texts = model.decode(ids.astype(np.int64), np.array(sizes[lo:hi], np.int64))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*(part[n] for n in kept), pa.array(texts, pa.string())], [*kept, out_col]
                )

    return df.mapInArrow(run, schema)
