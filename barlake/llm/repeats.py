"""Passages that may repeat: the candidate search that substring operators share.

Every window of ``length`` tokens is filed under its anchor, the gram inside it with the smallest
hash (the leftmost of equals). Equal windows have equal anchors, so

1. anchors are counted over all documents (partial counts are combined before the shuffle);
   an anchor that occurs once cannot lie in a repeated window;
2. the texts that hold repeated anchors are written once each, however many copies there are;
3. for each repeated anchor in them, the passage around it (all windows filed under it)
   is sent to the task of that anchor, where the exact comparison happens.

Nothing is sampled or capped: each window belongs to exactly one passage. Passages of an anchor
that more than ``HOT`` documents hold do not meet in one task: their windows are spread by a
128-bit hash of the window and compared by an aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import Scratch
from barlake.llm.text import column, mixed, rolling, utf8, word_hashes

# Documents that hold an anchor, beyond which its windows are spread.
HOT = 50_000
# Bytes of passages that a task compares at a time.
BLOCK_BYTES = 4_000_000

_SPAN = 1 << 23
_PLACE = np.uint64((1 << 24) - 1)
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            size = max(count, 1 << 16)
            cls.up, cls.down = _powers(_PRIME, size), _powers(_INVERSE, size)
        return cls.up[:count], cls.down[:count]


def byte_grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive bytes, from prefix sums of a polynomial."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    out = []
    for lo in range(0, len(data) - size + 1, _SPAN):
        part = data[lo : lo + _SPAN + size - 1].astype(np.uint64) + np.uint64(1)
        up, down = _Powers.of(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:-1], out=sums[1:])
        out.append(mixed((sums[size:] - sums[:-size]) * down[: len(part) - size + 1]))
    return np.concatenate(out)


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, and the first and last window filed under each; a window is ``width`` grams."""
    count = len(grams) - width + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    places, firsts, lasts = [], [], []
    for lo in range(0, count, _SPAN):
        part = grams[lo : min(lo + _SPAN, count) + width - 1]
        windows = len(part) - width + 1
        value = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(part) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(part)] = value
        table = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        behind = np.minimum.accumulate(table, axis=1).ravel()[width - 1 : width - 1 + windows]
        at = (np.minimum(ahead, behind) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        places.append(at[first] + lo)
        firsts.append(first + lo)
        lasts.append(np.concatenate((first[1:], [windows])) - 1 + lo)
    return np.concatenate(places), np.concatenate(firsts), np.concatenate(lasts)


@dataclass(frozen=True)
class Scheme:
    """How texts become tokens: windows of ``length`` tokens, anchors of ``gram`` tokens."""

    length: int
    gram: int
    words: bool

    def tokens(self, text: bytes):
        return text.split() if self.words else text

    def grams(self, tokens) -> np.ndarray:
        if len(tokens) < self.length:
            return np.zeros(0, np.uint64)
        if self.words:
            return rolling(word_hashes(tokens), self.gram)
        return byte_grams(np.frombuffer(tokens, np.uint8), self.gram)

    def anchors(self, tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        grams = self.grams(tokens)
        places, first, last = anchors(grams, self.length - self.gram + 1)
        return grams[places].view(np.int64) if len(places) else np.zeros(0, np.int64), places, first, last

    def passage(self, tokens, start: int, end: int) -> bytes:
        return b" ".join(tokens[start:end]) if self.words else tokens[start:end]

    def passages(self, tokens, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """``passage`` for several ranges of one text."""
        if self.words and len(starts):
            bounds = np.cumsum([0, *map(len, tokens)]) + np.arange(len(tokens) + 1)
            tokens, starts, ends = b" ".join(tokens), bounds[starts], bounds[ends] - 1
        return [tokens[lo:hi] for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]


TEXT_KEYS = ["t1", "t2"]


def keyed(docs: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and a 128-bit key of the text; a null text is empty."""
    text = F.coalesce(column(text_col), F.lit(""))
    return docs.select(
        column(key_col).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit("other"), text).alias("t2"),
    )


def suspects(rows: DataFrame, scheme: Scheme, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """One row per text that has a repeated anchor: ``t1, t2, copies, id`` (the smallest), ``text``,
    and its repeated anchors, those of very many documents apart (``hot``)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in utf8(batch["text"]):
                # Twice is enough to say that an anchor occurs again in its own text.
                hashes, times = np.unique(scheme.anchors(scheme.tokens(text))[0], return_counts=True)
                found.append(np.repeat(hashes, np.minimum(times, 2)))
            yield pa.RecordBatch.from_arrays(
                [batch["t1"], batch["t2"], pa.array(found, pa.list_(pa.int64()))], ["t1", "t2", "anchors"]
            )

    seen = rows.select("t1", "t2", "text").mapInArrow(find, "t1 long, t2 long, anchors array<long>")
    # Counted and then joined with the counts: the texts are read and hashed once for both. Beside an anchor goes the
    # number of its row, half as long as the key of its text and ascending, so that it takes little room on the way.
    held = Scratch(rows.sparkSession)
    stored = held.table(seen.withColumn("row", F.monotonically_increasing_id()), "anchors")
    seen = stored.select("row", F.explode("anchors").alias("anchor"))
    counts = seen.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    lists = (
        seen.join(counts, "anchor")
        .groupBy("row")
        .agg(
            F.collect_set(F.when(F.col("n") <= hot, F.col("anchor"))).alias("anchors"),
            F.collect_set(F.when(F.col("n") > hot, F.col("anchor"))).alias("hot"),
        )
    )
    # Rows of one text have the same anchors, so one of them stands for it.
    first = stored.groupBy(*TEXT_KEYS).agg(F.min("row").alias("row"))
    lists = lists.join(first, "row").drop("row")
    texts = rows.groupBy(*TEXT_KEYS).agg(
        F.count("*").alias("copies"), F.min("id").alias("id"), F.first("text").alias("text")
    )
    found = scratch.table(texts.join(lists, TEXT_KEYS), "suspects")
    held.clear()
    return found


def passages(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """One row per repeated anchor in a text: ``start`` is the first window filed under it,
    ``lead`` how far the anchor lies behind it."""
    key = texts.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, passage = [], []
            for i, (text, wanted) in enumerate(zip(utf8(batch["text"]), batch["anchors"], strict=True)):
                tokens = scheme.tokens(text)
                hashes, places, first, last = scheme.anchors(tokens)
                j = np.flatnonzero(np.isin(hashes, wanted.values.to_numpy()))
                found.append((np.full(len(j), i), hashes[j], first[j], places[j] - first[j]))
                passage += scheme.passages(tokens, first[j], last[j] + scheme.length)
            row, anchor, start, lead = map(np.concatenate, zip(*found, strict=True)) if found else np.zeros((4, 0), np.int64)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c].take(at) for c in ("t1", "t2", "id", "copies")),
                    pa.array(anchor, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(lead, pa.int64()),
                    pa.array(passage, pa.binary()),
                ],
                ["t1", "t2", "id", "copies", "anchor", "start", "lead", "passage"],
            )

    return texts.filter(F.size("anchors") > 0).select("t1", "t2", "id", "copies", "text", "anchors").mapInArrow(
        cut, f"t1 long, t2 long, id {key}, copies long, anchor long, start long, lead long, passage binary"
    )


def compared(found: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """Apply ``compare`` to blocks of whole anchors' passages; it gets a table and yields record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            held += waiting[-1].nbytes
            # The last anchor may go on in the next batch; nothing is joined while there is but one.
            if held < BLOCK_BYTES or waiting[0]["anchor"][0] == batch["anchor"][batch.num_rows - 1]:
                continue
            table = pa.concat_tables(waiting).combine_chunks()
            anchor = table["anchor"].to_numpy()
            end = int(np.searchsorted(anchor, anchor[-1]))
            if end:
                yield from compare(table.slice(0, end).combine_chunks())
                table = table.slice(end).combine_chunks()
            waiting, held = [table], table.nbytes
        if waiting:
            yield from compare(pa.concat_tables(waiting).combine_chunks())

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, schema)


def hot_windows(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Windows filed under hot anchors: ``t1, t2, id, copies, start, window`` (a 128-bit hash)."""
    key = texts.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, window = [], [], []
            for i, (text, wanted) in enumerate(zip(utf8(batch["text"]), batch["hot"], strict=True)):
                tokens = scheme.tokens(text)
                hashes, _, first, last = scheme.anchors(tokens)
                for j in np.flatnonzero(np.isin(hashes, wanted.values.to_numpy())).tolist():
                    for at in range(int(first[j]), int(last[j]) + 1):
                        row.append(i)
                        start.append(at)
                        window.append(xxhash.xxh3_128_digest(scheme.passage(tokens, at, at + scheme.length)))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].take(take) for c in ("t1", "t2", "id", "copies")), pa.array(start, pa.int64()), pa.array(window, pa.binary())],
                ["t1", "t2", "id", "copies", "start", "window"],
            )

    return texts.filter(F.size("hot") > 0).select("t1", "t2", "id", "copies", "text", "hot").mapInArrow(
        cut, f"t1 long, t2 long, id {key}, copies long, start long, window binary"
    )
