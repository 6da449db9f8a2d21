"""Benchmark decontamination: find test n-grams in training documents (operator 8).

The windows of the benchmark are a set of normalised word n-grams. They are broadcast in
blocks whose size is bounded, so a benchmark of any size works: each further block costs
one more scan of the documents. Hashes select window positions, and the words themselves
confirm every hit.

Nulls: a null text has no words; benchmark rows without id or words have no windows.
Repeated documents are judged one by one, extra columns are kept by the filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.text import alnum_words, column, cover, rolling, rollings, runs, utf8, word_hashes

# Windows in one broadcast block, about 100 bytes each in a task.
BLOCK_WINDOWS = 200_000
FILTER_BITS = 22
FILTER_SHIFT = np.uint64(64 - FILTER_BITS)

HITS = "key {key}, n_words long, starts array<int>, ends array<int>, items array<string>"


def benchmark_windows(
    benchmark: DataFrame, size: int = 10, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Distinct (item, phrase): every ``size`` consecutive words; a shorter item is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, phrases = [], []
            for item, text in zip(batch["item"].to_pylist(), utf8(batch["text"]), strict=True):
                words = alnum_words(text)
                if item is None or not words:
                    continue
                for start in range(max(1, len(words) - size + 1)):
                    items.append(item)
                    phrases.append(b" ".join(words[start : start + size]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(phrases, pa.binary())], ["item", "phrase"]
            )

    rows = benchmark.select(column(item_col).cast("string").alias("item"), column(text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, phrase binary").distinct()


def _scan(block: dict[bytes, list[str]]):
    """A function from words to the covered words and the items found."""
    by_length: dict[int, list[bytes]] = {}
    for phrase in block:
        by_length.setdefault(phrase.count(b" ") + 1, []).append(phrase)
    filters = {}
    for length, phrases in by_length.items():
        hashes = np.concatenate([rolling(word_hashes(p.split(b" ")), length) for p in phrases])
        table = np.zeros(1 << FILTER_BITS, bool)
        table[(hashes >> FILTER_SHIFT).astype(np.int64)] = True
        filters[length] = table

    def scan(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        starts, lengths, items = [], [], set()
        for length, found in rollings(word_hashes(words), sorted(filters)):
            places = filters[length][(found >> FILTER_SHIFT).view(np.int64)].nonzero()[0]
            for place in places.tolist():
                hit = block.get(b" ".join(words[place : place + length]))
                if hit is not None:
                    starts.append(place)
                    lengths.append(length)
                    items.update(hit)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), []
        covered = cover(len(words), np.array(starts), np.array(lengths))
        return *runs(covered), sorted(items)

    return scan


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    key_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per document row: ``key``, ``n_words``, maximal spans of hit words, and the items that hit.

    ``starts`` and ``ends`` are word places (end exclusive); ``items`` are sorted strings.
    """
    spark = docs.sparkSession
    windows = (
        benchmark_windows(benchmark, size, item_col, item_text_col)
        .groupBy("phrase")
        .agg(F.collect_list("item").alias("items"))
    )
    count = windows.count()
    n_blocks = max(1, -(-count // block_windows))
    key_type = docs.schema[key_col].dataType.simpleString()
    source = docs.select(column(key_col).alias("key"), column(text_col).alias("text"))
    if n_blocks > 1:
        source = source.withColumn("row", F.monotonically_increasing_id())
    schema = HITS.format(key=key_type) + (", row long" if n_blocks > 1 else "")

    def scan_block(number: int) -> DataFrame:
        rows = windows
        if n_blocks > 1:
            rows = windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(n_blocks)) == number)
        block = spark.sparkContext.broadcast(
            {bytes(row["phrase"]): row["items"] for row in rows.collect()}
        )

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scan = _scan(block.value)
            for batch in batches:
                out = []
                for text in utf8(batch["text"]):
                    words = alnum_words(text)
                    out.append((len(words), *scan(words)))
                counts, starts, ends, items = zip(*out, strict=True) if out else ((), (), (), ())
                arrays = [
                    batch["key"],
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                ]
                names = ["key", "n_words", "starts", "ends", "items"]
                if n_blocks > 1:
                    arrays.append(batch["row"])
                    names.append("row")
                yield pa.RecordBatch.from_arrays(arrays, names)

        return source.mapInArrow(find, schema)

    if n_blocks == 1:
        return scan_block(0)
    parts = [scan_block(number) for number in range(n_blocks)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return _merged(whole)


def _merged(parts: DataFrame) -> DataFrame:
    """One row per document from the rows of several blocks: spans that touch become one."""
    span = F.arrays_zip("starts", "ends")
    grouped = parts.groupBy("row").agg(
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(span))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def join(done, s):
        last = F.element_at(done, -1)
        widened = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], s["ends"]).alias("ends"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["ends"] >= s["starts"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(widened)),
        ).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<starts:int,ends:int>>")
    merged = F.aggregate("spans", empty, join)
    return grouped.withColumn("spans", merged).select(
        "key", "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, **columns: str) -> DataFrame:
    """The documents without a hit, all their columns unchanged."""
    key = columns.get("key_col", "doc_id")
    found = hits(docs, benchmark, size, **columns).filter(F.size("starts") > 0)
    bad = found.select(F.col("key").alias("__bad_key")).distinct()
    return docs.join(bad, column(key).eqNullSafe(F.col("__bad_key")), "left_anti")


def hit_digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate(
        F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
