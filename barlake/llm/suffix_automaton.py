"""Substring dedup: remove words whose window already occurs in an earlier document (operator 7).

The whole corpus is its own reference, so it cannot be broadcast; it is cut into shards that a task
can hold. A shard holds the passages of some anchors (see ``repeats``); as equal windows have
equal anchors, a passage needs to meet its own shard only. Each task builds the suffix automaton of
its shard's distinct passages, every state knowing the earliest document it occurs in, streams the
documents' passages through it for matching statistics, and marks the windows of at least
``length`` words that an earlier document holds. Marked windows of a document that touch become one span.

Nulls are texts without words. Words are judged on the input: a text that an earlier document
holds in full goes as a whole if it has ``length`` words. Rows without key take nothing from others
and lose nothing; rows that repeat a key are not earlier than each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import repeats
from barlake.llm.scratch import Scratch
from barlake.llm.text import column, cover, list_array, runs, utf8

NOBODY = np.iinfo(np.int64).max


class SuffixAutomaton:
    """Of several sequences; ``least`` of a state is the smallest owner of any place it ends at."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least = [NOBODY]

    def _split(self, state: int, token, target: int) -> int:
        """The part of ``target`` that is one longer than ``state``, as a state of its own."""
        edges, link = self.next, self.link
        clone = len(edges)
        edges.append(dict(edges[target]))
        self.length.append(self.length[state] + 1)
        self.least.append(NOBODY)
        link.append(link[target])
        link[target] = clone
        while state >= 0 and edges[state].get(token) == target:
            edges[state][token] = clone
            state = link[state]
        return clone

    def add(self, tokens: list, owner: int) -> None:
        edges, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for token in tokens:
            target = edges[last].get(token)
            if target is not None:
                last = target if length[target] == length[last] + 1 else self._split(last, token, target)
            else:
                state = len(edges)
                edges.append({})
                length.append(length[last] + 1)
                least.append(NOBODY)
                link.append(0)
                at = last
                while at >= 0:
                    ahead = edges[at]
                    if token in ahead:
                        target = ahead[token]
                        whole = length[target] == length[at] + 1
                        link[state] = target if whole else self._split(at, token, target)
                        break
                    ahead[token] = state
                    at = link[at]
                last = state
            if owner < least[last]:
                least[last] = owner

    def finish(self) -> None:
        """Hand the owners on to the shorter suffixes, from the longest states to the shortest."""
        least, link, length = np.array(self.least), np.array(self.link), np.array(self.length)
        order = np.argsort(length, kind="stable")
        bounds = np.searchsorted(length[order], np.arange(1, length[order[-1]] + 2))
        for lo, hi in zip(bounds[-2::-1], bounds[:0:-1], strict=True):
            states = order[lo:hi]
            np.minimum.at(least, link[states], least[states])
        self.least = least.tolist()

    def owners(self, tokens: list, size: int) -> list[int]:
        """The smallest owner of the window of ``size`` tokens that starts at each place."""
        edges, link, length, least = self.next, self.link, self.length, self.least
        state = matched = 0
        out = []
        for token in tokens:
            while state and token not in edges[state]:
                state = link[state]
                matched = length[state]
            target = edges[state].get(token)
            if target is None:
                matched = 0
            else:
                state = target
                matched += 1
                while length[link[state]] >= size:
                    state = link[state]
                matched = min(matched, length[state])
            out.append(least[state] if matched >= size else NOBODY)
        return out[size - 1 :]


SPANS = "t1 long, t2 long, starts array<long>, ends array<long>"


def _compare(length: int):
    def compare(block: pa.Table) -> Iterator[pa.RecordBatch]:
        coded = block["passage"].combine_chunks().dictionary_encode()
        content, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        ids = block["id"].combine_chunks()
        rank = pc.rank(ids, null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        owner = np.full(len(distinct), NOBODY, np.int64)
        np.minimum.at(owner, content[known], rank[known])
        anchor = block["anchor"].to_numpy()
        first_row = np.zeros(len(distinct), np.int64)
        first_row[content[::-1]] = np.arange(len(content))[::-1]
        group = np.unique(anchor[first_row], return_inverse=True)[1]
        several = np.bincount(group)[group] > 1
        automaton = SuffixAutomaton()
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        tokens = {
            i: [number(word, len(numbers)) for word in distinct[i].split()] for i in np.flatnonzero(several).tolist()
        }
        for i, words in tokens.items():
            automaton.add(words, int(owner[i]))
        automaton.finish()
        begin = block["start"].to_numpy()
        mine = np.where(known, rank, -1)
        # The holder with the smallest id loses something only where another passage is earlier.
        rows = np.flatnonzero(several[content] | (owner[content] < mine))
        # Windows of each passage, and their smallest and largest owners.
        windows = np.fromiter((d.count(b" ") for d in distinct), np.int64, len(distinct)) + 2 - length
        low, high = owner.copy(), owner.copy()
        seen: dict[int, np.ndarray] = {}
        for i in tokens:
            seen[i] = np.array(automaton.owners(tokens[i], length), np.int64)
            low[i], high[i] = seen[i].min(), seen[i].max()
        rows = rows[low[content[rows]] < mine[rows]]
        partly = high[content[rows]] >= mine[rows]
        whole, rest = rows[~partly], rows[partly]
        starts, ends, counts = [begin[whole]], [begin[whole] + windows[content[whole]] + length - 1], []
        for row in rest.tolist():
            earlier = seen[int(content[row])] < mine[row]
            lo, hi = runs(cover(len(earlier) + length - 1, np.flatnonzero(earlier), length))
            counts.append(len(lo))
            starts.append(lo + begin[row])
            ends.append(hi + begin[row])
        at = pa.array(np.concatenate((whole, rest)))
        spans = np.concatenate((np.ones(len(whole), np.int64), np.array(counts, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [
                block["t1"].combine_chunks().take(at),
                block["t2"].combine_chunks().take(at),
                list_array(np.concatenate(starts), spans, pa.int64()),
                list_array(np.concatenate(ends), spans, pa.int64()),
            ],
            ["t1", "t2", "starts", "ends"],
        )

    return compare


def _hot_spans(texts: DataFrame, scheme: repeats.Scheme) -> DataFrame:
    windows = repeats.hot_windows(texts, scheme)
    earliest = windows.groupBy("window").agg(F.min("id").alias("earliest"))
    found = windows.join(earliest, "window").filter("earliest < id")
    found = found.groupBy("t1", "t2").agg(F.collect_list("start").alias("starts"))
    return found.withColumn("ends", F.transform("starts", lambda s: s + scheme.length))


def word_rows(rows: DataFrame) -> DataFrame:
    """Of ``repeats.keyed`` rows: ``id, t1, t2``, ``n_words``, and ``own``, the words joined by spaces."""
    key = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, own = [], []
            # One text's words at a time: those of a batch would take many times its size.
            for text in utf8(batch["text"]):
                tokens = text.split()
                n_words.append(len(tokens))
                own.append(b" ".join(tokens))
            kept = [batch[c] for c in ("id", "t1", "t2")]
            left = pa.array(own, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_words, pa.int64()), left], ["id", "t1", "t2", "n_words", "own"]
            )

    return rows.select("id", "t1", "t2", "text").mapInArrow(
        count, f"id {key}, t1 long, t2 long, n_words long, own string"
    )


def repeated_words(
    docs: DataFrame,
    length: int = 13,
    gram: int = 5,
    key_col: str = "doc_id",
    text_col: str = "text",
    hot: int = repeats.HOT,
) -> DataFrame:
    """Per distinct text that loses words, or that several documents hold: ``t1, t2``, ``first_id``
    (its first document), the spans of words this one loses, and ``kept``, its other words."""
    scratch = Scratch(docs.sparkSession)
    scheme = repeats.Scheme(length, gram, True)
    rows = repeats.keyed(docs, key_col, text_col)
    texts = repeats.suspects(rows, scheme, scratch, hot)
    found = repeats.compared(
        repeats.passages(texts, scheme).drop("copies", "lead"), _compare(length), SPANS
    ).unionByName(_hot_spans(texts, scheme))
    spans = found.groupBy("t1", "t2").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    joined = texts.select("t1", "t2", "copies", "id", "text").join(spans, ["t1", "t2"], "left")
    joined = joined.filter("copies > 1 or starts is not null").withColumnRenamed("id", "first_id")
    key = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            out = []
            for text, starts, ends in zip(utf8(batch["text"]), batch["starts"], batch["ends"], strict=True):
                tokens = text.split()
                marks = np.zeros(len(tokens), bool)
                if starts.is_valid:
                    lo, hi = starts.values.to_numpy(), ends.values.to_numpy()
                    marks = cover(len(tokens), lo, hi - lo)
                kept = b" ".join(tokens[i] for i in np.flatnonzero(~marks).tolist())
                out.append((len(tokens), *runs(marks), kept.decode("utf-8", "replace")))
            count, lo, hi, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in ("t1", "t2", "first_id")),
                    pa.array(count, pa.int64()),
                    pa.array(lo, kind),
                    pa.array(hi, kind),
                    pa.array(kept, pa.string()),
                ],
                ["t1", "t2", "first_id", "n_words", "starts", "ends", "kept"],
            )

    schema = f"t1 long, t2 long, first_id {key}, n_words long, starts array<long>, ends array<long>, kept string"
    cut_texts = joined.select("t1", "t2", "first_id", "text", "starts", "ends").mapInArrow(cut, schema)
    result = scratch.result(cut_texts, "repeated-words")
    scratch.clear()
    return result


def left_over(rows: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """Rows of ``word_rows`` with what ``repeated_words`` found for their texts: ``id``, ``n_words``, ``n_removed`` and ``kept``.

    ``own`` and ``kept`` may be digests, if both are; ``kept`` is null where nothing is left of a later copy.
    """
    joined = rows.join(repeated.select("t1", "t2", "first_id", "starts", "ends", "kept"), ["t1", "t2"], "left")
    later = F.coalesce(F.col("id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= length)
    first = F.coalesce(F.col("id") == F.col("first_id"), F.lit(False)) & (F.size("starts") > 0)
    removed = F.aggregate(
        F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda total, n: total + n
    )
    return joined.select(
        "id",
        "n_words",
        F.when(later, F.col("n_words")).when(first, removed).otherwise(0).alias("n_removed"),
        F.when(later, None).when(first, F.col("kept")).otherwise(F.col("own")).alias("kept"),
    )


def deduplicated(
    docs: DataFrame, length: int = 13, key_col: str = "doc_id", text_col: str = "text", **more
) -> DataFrame:
    """Per document row: ``id``, ``n_words``, ``n_removed`` and ``kept``, its other words joined by spaces."""
    repeated = repeated_words(docs, length, key_col=key_col, text_col=text_col, **more)
    left = left_over(word_rows(repeats.keyed(docs, key_col, text_col)), repeated, length)
    return left.withColumn("kept", F.coalesce("kept", F.lit("")))


def digests(docs: DataFrame, length: int = 13, key_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """As ``deduplicated``, with the SHA-256 of ``kept`` for it: no text is shuffled to say what is left of it."""
    repeated = repeated_words(docs, length, key_col=key_col, text_col=text_col, **more)
    rows = word_rows(repeats.keyed(docs, key_col, text_col)).withColumn("own", F.sha2("own", 256))
    left = left_over(rows, repeated.withColumn("kept", F.sha2("kept", 256)), length)
    return left.withColumn("kept", F.coalesce("kept", F.sha2(F.lit("").cast("binary"), 256)))
