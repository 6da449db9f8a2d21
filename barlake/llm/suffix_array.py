"""Suffix-array dedup: remove every byte of a long string that occurs elsewhere (operator 9).

Candidate passages come from ``repeats``; each task then sorts the suffixes of its passages, one
bucket of leading bytes at a time. Suffixes are sorted by their first ``PERIOD`` bytes. Longer ties
are resolved by the ranks of a difference-cover sample, computed beforehand by doubling: for any
two suffixes there is a shift below the period after which both stand on sample places. So the
extra memory is the sample's ranks and one bucket, not a rank for every suffix. Neighbours in the
sorted order that agree in ``length`` bytes are repeats.

Passages are laid out so that their anchors stand on one residue. Equal windows then have equal
residues, and a tie is sorted by one rank; ties of mixed residues are sorted pair by pair.

Nulls are empty texts; texts shorter than ``length`` bytes lose nothing. A text that several
documents hold in full is one text with copies, all of whose bytes repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import repeats
from barlake.llm.scratch import Scratch
from barlake.llm.text import column, cover, runs, utf8

# A perfect difference set: each difference modulo 31 occurs once. Fixed values.
PERIOD = 31
COVER = [1, 5, 11, 24, 25, 27]
BUCKET_SUFFIXES = 200_000


def _shifts() -> np.ndarray:
    """For residues i and j the smallest shift that puts both on the cover."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            table[i, j] = next(d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER)
    return table


SHIFTS = _shifts()


def _prefix_keys(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The first 31 bytes at each place as four whole numbers, most significant first."""
    return [words[at], words[at + 8], words[at + 16], words[at + 24] >> np.uint64(8)]


def _ranked(keys: list[np.ndarray]) -> np.ndarray:
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


class SuffixSorter:
    """Sorts suffixes of a text by at least their first ``depth`` bytes."""

    def __init__(self, text: bytes, depth: int):
        self.depth = depth
        room = 2 * PERIOD + depth
        self.data = np.frombuffer(text + bytes(8 * PERIOD + 2 * room), np.uint8)
        size = len(text) + room
        # Big-endian words at every place, so that whole numbers compare as bytes do.
        words = np.zeros(len(self.data) - 7, np.uint64)
        for shift in range(8):
            words = (words << np.uint64(8)) | self.data[shift : shift + len(words)]
        self.words = words
        place = np.arange(size)
        sample = np.flatnonzero(np.isin(place % PERIOD, COVER))
        self.rank = np.zeros(size + PERIOD, np.int64)
        ranks = _ranked(_prefix_keys(words, sample))
        reach = PERIOD
        while reach < depth:
            self.rank[sample] = ranks + 1
            beyond = np.where(sample + reach < size, self.rank[np.minimum(sample + reach, size)], 0)
            ranks = _ranked([ranks, beyond])
            reach *= 2
        self.rank[sample] = ranks + 1

    def buckets(self, starts: np.ndarray) -> Iterator[np.ndarray]:
        """The suffixes of one range of leading bytes after the other, each sorted."""
        lead = self.words[starts]
        count = -(-len(starts) // BUCKET_SUFFIXES)
        cuts = np.unique(np.sort(lead)[:: max(1, len(starts) // count)][1:]) if count > 1 else lead[:0]
        bucket = np.searchsorted(cuts, lead, side="right")
        for number in range(len(cuts) + 1):
            yield self._sorted(starts[bucket == number])

    def _sorted(self, starts: np.ndarray) -> np.ndarray:
        keys = _prefix_keys(self.words, starts)
        order = np.lexsort(keys[::-1])
        starts, keys = starts[order], [k[order] for k in keys]
        new = np.ones(len(starts), bool)
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        residue = starts % PERIOD
        first = residue[np.flatnonzero(new)][group]
        mixed = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        mixed[group[residue != first]] = True
        # Equal residues: one shift serves the whole tie.
        by = self.rank[starts + SHIFTS[residue, residue]]
        starts = starts[np.lexsort((by, group))]
        for tie in np.flatnonzero(mixed).tolist():
            lo, hi = np.searchsorted(group, [tie, tie + 1])
            starts[lo:hi] = sorted(starts[lo:hi].tolist(), key=cmp_to_key(self._compare))
        return starts

    def _compare(self, i: int, j: int) -> int:
        shift = SHIFTS[i % PERIOD, j % PERIOD]
        return int(self.rank[i + shift]) - int(self.rank[j + shift])

    def equal(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the first ``depth`` bytes agree."""
        same = np.ones(len(one), bool)
        for at in [*range(0, self.depth - 7, 8), self.depth - 8]:
            left = np.flatnonzero(same)
            same[left] = self.words[one[left] + at] == self.words[two[left] + at]
        return same


def repeated_windows(passages: list[bytes], leads: list[int], length: int) -> list[np.ndarray]:
    """For each of some distinct passages, which of its windows also start elsewhere in them."""
    parts, begins, at = [], [], 0
    for passage, lead in zip(passages, leads, strict=True):
        pad = -(at + lead) % PERIOD
        parts += [bytes(pad), passage]
        begins.append(at + pad)
        at += pad + len(passage)
    sorter = SuffixSorter(b"".join(parts), length)
    counts = np.array([len(p) - length + 1 for p in passages])
    starts = np.repeat(np.array(begins), counts) + np.concatenate([np.arange(c) for c in counts])
    marked = np.zeros(at + 1, bool)
    for ordered in sorter.buckets(starts):
        same = sorter.equal(ordered[:-1], ordered[1:])
        marked[ordered[:-1][same]] = True
        marked[ordered[1:][same]] = True
    return [marked[b : b + c] for b, c in zip(begins, counts.tolist(), strict=True)]


SPANS = "t1 long, t2 long, starts array<long>, ends array<long>"


def _compare(length: int):
    def compare(block: pa.Table) -> Iterator[pa.RecordBatch]:
        passages, leads = block["passage"].combine_chunks(), block["lead"].to_numpy()
        coded = passages.dictionary_encode()
        content = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        anchor = block["anchor"].to_numpy()
        # A passage held several times repeats as a whole; one without company under its anchor is alone.
        times = np.bincount(content, minlength=len(distinct))
        lone = np.zeros(len(distinct), bool)
        first_row = np.zeros(len(distinct), np.int64)
        first_row[content[::-1]] = np.arange(len(content))[::-1]
        group = np.unique(anchor[first_row], return_inverse=True)[1]
        lone = np.bincount(group)[group] == 1
        marks = [np.full(len(p) - length + 1, t > 1) for p, t in zip(distinct, times.tolist(), strict=True)]
        several = np.flatnonzero(~lone).tolist()
        if several:
            found = repeated_windows([distinct[i] for i in several], leads[first_row[several]].tolist(), length)
            for i, mark in zip(several, found, strict=True):
                marks[i] |= mark
        starts, ends, rows = [], [], []
        begin = block["start"].to_numpy()
        covered: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for row, i in enumerate(content.tolist()):
            if i not in covered:
                covered[i] = runs(cover(len(distinct[i]), np.flatnonzero(marks[i]), length))
            lo, hi = covered[i]
            if len(lo):
                rows.append(row)
                starts.append(lo + begin[row])
                ends.append(hi + begin[row])
        at = pa.array(rows, pa.int64())
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [block["t1"].combine_chunks().take(at), block["t2"].combine_chunks().take(at), pa.array(starts, kind), pa.array(ends, kind)],
            ["t1", "t2", "starts", "ends"],
        )

    return compare


def _hot_spans(texts: DataFrame, scheme: repeats.Scheme) -> DataFrame:
    windows = repeats.hot_windows(texts, scheme)
    common = windows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1").select("window")
    found = windows.join(common, "window").groupBy("t1", "t2").agg(F.collect_list("start").alias("starts"))
    return found.withColumn("ends", F.transform("starts", lambda s: s + scheme.length))


def repeated_spans(
    docs: DataFrame,
    length: int = 200,
    gram: int = 64,
    key_col: str = "doc_id",
    text_col: str = "text",
    hot: int = repeats.HOT,
) -> DataFrame:
    """Per distinct text with repeats: its key ``t1, t2`` (see ``repeats.keyed``), the maximal byte spans
    to remove (``starts``, ``ends``), and ``kept``, the remaining bytes."""
    scratch = Scratch(docs.sparkSession)
    scheme = repeats.Scheme(length, gram, False)
    rows = repeats.keyed(docs, key_col, text_col)
    texts = repeats.suspects(rows, scheme, scratch, hot)
    found = repeats.compared(
        repeats.passages(texts, scheme).drop("id", "copies"), _compare(length), SPANS
    ).unionByName(_hot_spans(texts, scheme))
    spans = found.groupBy("t1", "t2").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    joined = texts.select("t1", "t2", "copies", "text").join(spans, ["t1", "t2"], "left")
    joined = joined.filter("copies > 1 or starts is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            out = []
            columns = (utf8(batch["text"]), batch["copies"].to_pylist(), batch["starts"], batch["ends"])
            for text, copies, starts, ends in zip(*columns, strict=True):
                marks = np.zeros(len(text), bool)
                if copies > 1 and len(text) >= length:
                    marks[:] = True
                elif starts.is_valid:
                    lo, hi = starts.values.to_numpy(), ends.values.to_numpy()
                    marks = cover(len(text), lo, hi - lo)
                kept = np.frombuffer(text, np.uint8)[~marks].tobytes()
                out.append((*runs(marks), kept))
            lo, hi, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["t1"], batch["t2"], pa.array(lo, kind), pa.array(hi, kind), pa.array(kept, pa.binary())],
                ["t1", "t2", "starts", "ends", "kept"],
            )

    result = scratch.result(
        joined.select("t1", "t2", "copies", "text", "starts", "ends").mapInArrow(cut, SPANS + ", kept binary").filter(F.size("starts") > 0),
        "repeated-spans",
    )
    scratch.clear()
    return result


def remove_repeats(
    docs: DataFrame, length: int = 200, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with repeated bytes removed from their texts.

    Bytes of a character that was cut in two go too. All columns but the text stay as they
    are, rows that lose nothing are unchanged, and no row is dropped.
    """
    spans = repeated_spans(docs, length, key_col=key_col, text_col=text_col)
    # The cast does not look at the bytes; pieces of cut characters become U+FFFD, which then goes,
    # unless the text has that character itself.
    kept = F.make_valid_utf8(F.col("kept").cast("string"))
    clean = spans.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), kept.alias("__kept"))
    text = F.coalesce(column(text_col), F.lit(""))
    row = F.struct(*(column(c) for c in docs.columns)).alias("__row")
    marked = docs.select(row, F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit("other"), text).alias("__t2"))
    joined = marked.join(clean, ["__t1", "__t2"], "left")

    def value(name: str):
        own = F.col("__row")[name]
        if name != text_col:
            return own.alias(name)
        cut = F.when(F.contains(own, F.lit("\ufffd")), F.col("__kept")).otherwise(
            F.replace("__kept", F.lit("\ufffd"), F.lit(""))
        )
        return F.when(F.col("__kept").isNotNull(), cut).otherwise(own).alias(name)

    return joined.select(*(value(c) for c in docs.columns))
