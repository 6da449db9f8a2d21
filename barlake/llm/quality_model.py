"""Quality classifier: perplexity under an n-gram model of trusted text (operator 1).

The model is an interpolated modified Kneser-Ney bigram model over a vocabulary of ``VOCABULARY``
entries: the most frequent words of the trusted text, and classes of word shapes (length, digits,
symbols, capitals, letters beyond ASCII) for all other words, so that no word is without a probability.
Two ids make one 32-bit key.

Counts grow with the corpus and never leave the executors: training tasks send distinct bigrams and
their counts to the shard of the key, which keeps them sorted. Scoring tasks send every bigram of
every document there too; each shard reads its counts first and then streams the requests, so its
memory holds counts, not documents. Partial sums come back per document and are added up. Only tables
as long as the vocabulary pass through the driver.

A fifth of the trusted documents is held out from training. A document is kept if its perplexity is at most the
``QUANTILE`` of the held-out documents of its language, however many there are. The largest of n documents stands at
n / (n + 1) only; where that is below the quantile, the distance between the two among the held-out documents of all
languages is added. A language without held-out documents has no threshold (infinity): its documents are kept.
All counts cover all documents.

Rows without words have no perplexity and are not kept; rows without key have neither. Rows that repeat a key are
scored as one document. A null language is a language of its own. Without trusted text nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.scratch import Scratch
from barlake.llm.text import chunks, column, mixed, utf8

VOCABULARY = 1 << 16
SHAPES = 128
START = SHAPES
FIRST_WORD = SHAPES + 1
QUANTILE = 0.995
HELD_OUT = 5
# Text of one request block, text that one shard answers for, and labels that may be broadcast.
BLOCK_BYTES = 4_000_000
SHARD_BYTES = 64_000_000
BROADCAST_LABELS = 1_000_000

_SYMBOLS = frozenset(b"#*$%&|<>@=+~^_{}[]\\/")
_DIGITS = frozenset(b"0123456789")


def shape(word: bytes) -> int:
    """The class of a word outside the vocabulary."""
    size = min(3, (len(word) - 1) // 4)
    held = frozenset(word)
    digit = not held.isdisjoint(_DIGITS)
    symbol = not held.isdisjoint(_SYMBOLS)
    upper = len(word) > 1 and word.isupper()
    beyond = not word.isascii()
    punctuation = word[-1:] in (b".", b",", b"!", b"?", b";", b":")
    return size | digit << 2 | symbol << 3 | upper << 4 | beyond << 5 | punctuation << 6


@dataclass
class Model:
    """The parts of the model that are as long as the vocabulary; bigram counts stay in shards."""

    words: dict[int, int]
    entries: int
    totals: np.ndarray
    gamma: np.ndarray
    lower: np.ndarray
    discounts: np.ndarray

    def log_probability(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log probabilities of bigrams, given how often the trusted text has each."""
        before, word = keys >> np.uint32(16), keys & np.uint32(0xFFFF)
        backed = self.gamma[before] * self.lower[word]
        own = counts - self.discounts[np.minimum(counts, 3)]
        seen = np.where(counts > 0, own / np.maximum(self.totals[before], 1), 0.0)
        return np.log(seen + backed)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and from 3 on; 0.5, 1 and 1.5 where counts are too few."""
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.05), c - 0.05) for c, d in enumerate(raw, 1))])


def word_ids(texts: list[bytes], words: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of the texts, and the number of words of each."""
    parts = [text.split() for text in texts]
    flat = [w for part in parts for w in part]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    if not flat:
        return np.zeros(0, np.uint32), counts
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    known = [_word_id(w, words) for w in coded.dictionary.to_pylist()]
    return np.array(known, np.uint32)[coded.indices.to_numpy()], counts


def _word_id(word: bytes, words: dict[int, int]) -> int:
    number = words.get(xxhash.xxh3_64_intdigest(word.lower()))
    return shape(word) if number is None else number


def bigrams(texts: list[bytes], words: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bigrams, the first of each text after the start, and their numbers."""
    ids, counts = word_ids(texts, words)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    starts = (np.cumsum(counts) - counts)[counts > 0]
    before[starts] = START
    return before << np.uint32(16) | ids, counts


def _packed(keys: np.ndarray) -> bytes:
    """Keys compressed, the first ids apart from the second: frequent words take few bits."""
    halves = np.ascontiguousarray(keys.astype("<u4").view("<u2").reshape(-1, 2).T)
    return zstandard.ZstdCompressor(level=1).compress(halves.tobytes())


def _unpacked(content: bytes) -> np.ndarray:
    halves = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), "<u2").reshape(2, -1)
    return np.ascontiguousarray(halves.T).view("<u4").ravel()


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts keys by shard, and the bounds of the shards in it."""
    shard = _shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def trusted_rows(
    rows: DataFrame, labels: DataFrame, key_col: str, quality_col: str, toxic_col: str | None = None
) -> DataFrame:
    """``rows`` with ``trusted``: 1 for training, 2 for held out, else 0; a label as toxic outweighs the others."""
    toxic = F.lit(False) if toxic_col is None else F.coalesce(column(toxic_col) == 1, F.lit(False))
    marks = labels.filter(column(key_col).isNotNull()).select(
        column(key_col).cast("long").alias("id"), (column(quality_col) == 1).alias("good"), toxic.alias("toxic")
    )
    good = marks.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    good = good.filter(F.col("good") & ~F.col("toxic")).select("id")
    part = F.when(F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0, 2).otherwise(1)
    good = good.withColumn("part", part)
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    return rows.join(good, "id", "left").withColumn("trusted", F.coalesce("part", F.lit(0))).drop("part")


def _vocabulary(rows: DataFrame) -> dict[int, int]:
    """Ids of the most frequent words of the trusted text, by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [w for text in utf8(batch["text"]) for w in text.lower().split()]
            counted = pa.array(flat, pa.binary()).value_counts()
            hashes = [xxhash.xxh3_64_intdigest(w) for w in counted.field("values").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(hashes, np.uint64).view(np.int64)), counted.field("counts").cast(pa.int64())], ["word", "n"]
            )

    counted = rows.filter("trusted = 1").select("text").mapInArrow(run, "word long, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    best = top.orderBy(F.desc("n"), "word").limit(VOCABULARY - FIRST_WORD).collect()
    return {row["word"] & (1 << 64) - 1: n for n, row in enumerate(best, FIRST_WORD)}


def _counts(rows: DataFrame, words, shards: int, scratch: Scratch) -> DataFrame:
    """Per shard its sorted bigram keys and their counts in the training text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            for lo, hi in chunks([len(t) for t in texts], BLOCK_BYTES):
                keys, counts = np.unique(bigrams(texts[lo:hi], words.value)[0], return_counts=True)
                order, bounds = _by_shard(keys, shards)
                out = []
                for s in np.flatnonzero(np.diff(bounds)).tolist():
                    at = order[bounds[s] : bounds[s + 1]]
                    out.append((s, _packed(keys[at]), counts[at].astype(np.uint32).tobytes()))
                yield _rows(out, ["shard", "keys", "counts"], [pa.int32(), pa.binary(), pa.binary()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _streams(batches, "shard"):
            keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            for part in parts:
                for k, c in zip(part["keys"].to_pylist(), part["counts"].to_pylist(), strict=True):
                    waiting.append((_unpacked(k), np.frombuffer(c, np.uint32).astype(np.int64)))
                if sum(len(k) for k, _ in waiting) > 2_000_000:
                    keys, counts = _summed([(keys, counts), *waiting])
                    waiting = []
            keys, counts = _summed([(keys, counts), *waiting])
            row = (shard, _packed(keys), np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes())
            yield _rows([row], ["shard", "keys", "counts"], [pa.int32(), pa.binary(), pa.binary()])

    schema = "shard int, keys binary, counts binary"
    sent = rows.filter("trusted = 1").select("text").mapInArrow(send, schema)
    return scratch.table(sent.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(add, schema), "ngram-counts")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    distinct, places = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, places, counts)
    return distinct, sums


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _streams(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Per value of a sorted column, its rows as they come."""
    current: list = []
    source = iter(batches)

    def pull() -> bool:
        for batch in source:
            if batch.num_rows:
                current.append(batch)
                return True
        return False

    while current or pull():
        value = current[0][name][0].as_py()

        def parts(value=value) -> Iterator[pa.RecordBatch]:
            while current or pull():
                batch = current.pop()
                values = batch[name].to_numpy()
                end = int(np.searchsorted(values, value, side="right"))
                if end:
                    yield batch.slice(0, end)
                if end < batch.num_rows:
                    current.append(batch.slice(end))
                    return

        yield value, parts()


def _statistics(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per id: tokens after it, words seen once, twice and more often after it, and words before it;
    and how many bigrams were seen 1 to 4 times. As long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                keys, n = _unpacked(k), np.frombuffer(c, np.uint32).astype(np.int64)
                before, word = keys >> np.uint32(16), keys & np.uint32(0xFFFF)
                size = VOCABULARY
                sums = np.zeros((6, size), np.int64)
                np.add.at(sums[0], before, n)
                for row, chosen in ((1, n == 1), (2, n == 2), (3, n > 2)):
                    sums[row] = np.bincount(before[chosen], minlength=size)
                sums[4] = np.bincount(word, minlength=size)
                # The counts of counts take the first places of the last row.
                sums[5, :4] = [(n == i).sum() for i in (1, 2, 3, 4)]
                at = np.flatnonzero(sums.any(axis=0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), *(pa.array(s[at]) for s in sums)], ["id", *(f"s{i}" for i in range(6))]
                )

    schema = "id long, " + ", ".join(f"s{i} long" for i in range(6))
    summed = counts.mapInArrow(run, schema).groupBy("id").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(6)))
    table = np.zeros((6, VOCABULARY), np.int64)
    for row in summed.collect():
        table[:, row["id"]] = [row[f"s{i}"] for i in range(6)]
    return table[:5], table[5, :4]


def _model(words: dict[int, int], table: np.ndarray, times: np.ndarray) -> Model:
    totals, n1, n2, n3, before = table.astype(np.float64)
    d = discounts(*times.tolist())
    with np.errstate(divide="ignore", invalid="ignore"):
        gamma = np.where(totals > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / totals, 1.0)
    entries = FIRST_WORD + len(words)
    lower_times = [int((before == i).sum()) for i in (1, 2, 3, 4)]
    e = discounts(*lower_times)
    whole = max(before.sum(), 1.0)
    kinds = np.minimum(before, 3).astype(np.int64)
    freed = e[kinds].sum() / whole if before.sum() else 1.0
    lower = np.where(before > 0, (before - e[kinds]) / whole, 0.0) + freed / entries
    return Model(words, entries, totals, gamma, lower, d)


def _scores(rows: DataFrame, model, counts: DataFrame, shards: int) -> DataFrame:
    """Per document ``id``: ``log_probability`` and ``n_words``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch["text"])
            ids = batch["id"].to_numpy()
            for lo, hi in chunks([len(t) for t in texts], BLOCK_BYTES):
                keys, sizes = bigrams(texts[lo:hi], model.value.words)
                owner = np.repeat(np.arange(hi - lo), sizes)
                order, bounds = _by_shard(keys, shards)
                out = []
                for s in np.flatnonzero(np.diff(bounds)).tolist():
                    at = order[bounds[s] : bounds[s + 1]]
                    mine = owner[at]
                    first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
                    lengths = np.diff(np.concatenate((first, [len(at)]))).astype(np.uint32)
                    docs = ids[lo:hi][mine[first]].astype(np.int64)
                    out.append((s, _packed(keys[at]), lengths.tobytes(), docs.tobytes()))
                yield _rows(out, ["shard", "keys", "counts", "docs"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _streams(batches, "shard"):
            known, times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            for part in parts:
                for k, c, d in zip(*(part[n].to_pylist() for n in ("keys", "counts", "docs")), strict=True):
                    keys, lengths = _unpacked(k), np.frombuffer(c, np.uint32).astype(np.int64)
                    if d is None:
                        known, times = keys, lengths
                        continue
                    n = np.zeros(len(keys), np.int64)
                    if len(known):
                        order = np.argsort(keys)
                        places = np.minimum(np.searchsorted(known, keys[order]), len(known) - 1)
                        n[order] = np.where(known[places] == keys[order], times[places], 0)
                    sums = np.add.reduceat(model.value.log_probability(keys, n), np.cumsum(lengths) - lengths)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.frombuffer(d, np.int64)), pa.array(sums), pa.array(lengths)], ["id", "sum", "n"]
                    )

    schema = "shard int, keys binary, counts binary, docs binary"
    asked = rows.filter("id is not null").select("id", "text").mapInArrow(ask, schema)
    answers = (
        counts.withColumn("docs", F.lit(None).cast("binary"))
        .unionByName(asked)
        .withColumn("asks", F.col("docs").isNotNull())
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "asks")
        .mapInArrow(answer, "id long, sum double, n long")
    )
    return answers.groupBy("id").agg(F.sum("sum").alias("log_probability"), F.sum("n").alias("n_words"))


def thresholds(scored: DataFrame, quantile: float = QUANTILE, least: int = 1) -> DataFrame:
    """Per language the perplexity (its log, in steps of 1/256) that the quantile of held-out documents reach.

    ``lang`` null with ``every`` true is the row for all languages.
    """
    held = scored.filter("trusted = 2 and log_perplexity is not null")
    step = F.ceil(F.col("log_perplexity") * 256)
    both = held.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("every"), "language", step.alias("step"))
    both = both.withColumn("language", F.when(~F.col("every"), F.col("language")).otherwise(""))
    counts = both.groupBy("every", "language", "step").agg(F.count("*").alias("n"))
    group = Window.partitionBy("every", "language")
    ranked = counts.withColumns({"upto": F.sum("n").over(group.orderBy("step")), "all": F.sum("n").over(group)})
    reached = ranked.filter(F.col("upto") >= quantile * F.col("all"))
    limits = reached.groupBy("every", "language").agg(F.min("step").alias("step"), F.max("all").alias("n_held_out"))
    limits = limits.filter(F.col("every") | (F.col("n_held_out") >= least))
    # The share that the largest of a language's documents stands for, if that is below the quantile.
    stands = F.col("n_held_out") / (F.col("n_held_out") + 1)
    few = limits.filter(~F.col("every") & (stands < quantile)).select("language", stands.alias("stands"))
    tail = ranked.filter("every").select(F.col("step").alias("low"), "upto", "all")
    tail = few.join(tail, F.col("upto") >= F.col("stands") * F.col("all")).groupBy("language").agg(F.min("low").alias("low"))
    whole = limits.filter("every").agg(F.max("step")).scalar()
    gap = F.when(F.col("every"), 0).otherwise(F.coalesce(whole - F.col("low"), F.lit(0)))
    return limits.join(tail, "language", "left").select(
        "every", "language", ((F.col("step") + gap) / 256).alias("threshold"), "n_held_out"
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quality_col: str = "quality",
    quantile: float = QUANTILE,
    toxic_col: str | None = None,
) -> DataFrame:
    """Per document row: ``id``, ``lang``, ``n_words``, ``perplexity``, ``threshold`` and ``kept``.

    With ``toxic_col`` documents labelled toxic neither train the model nor set a threshold.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(
        column(key_col).cast("long").alias("id"), column(text_col).alias("text"), column(lang_col).alias("lang")
    )
    rows = trusted_rows(rows, labels, key_col, quality_col, toxic_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    words = spark.sparkContext.broadcast(_vocabulary(rows))
    counts = _counts(rows, words, shards, scratch)
    model = spark.sparkContext.broadcast(_model(words.value, *_statistics(counts)))
    scores = _scores(rows, model, counts, shards)
    own = rows.select("id", "lang", "trusted").withColumn("language", F.coalesce("lang", F.lit("")))
    scored = own.join(scores, "id", "left").withColumn(
        "log_perplexity", -F.col("log_probability") / F.col("n_words")
    )
    scored = scratch.result(scored, "perplexities")
    limits = thresholds(scored, quantile)
    by_language = limits.filter("not every").select("language", F.col("threshold").alias("own_threshold"))
    joined = scored.join(by_language, "language", "left")
    limit = F.coalesce("own_threshold", F.lit(float("inf")))
    result = joined.select(
        "id",
        "lang",
        F.coalesce("n_words", F.lit(0)).alias("n_words"),
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        (F.col("log_perplexity").isNotNull() & (F.col("log_perplexity") <= limit)).alias("kept"),
    )
    scratch.clear()
    return result
