"""Ranked lexical search, term at a time for short lists and document at a time for long ones (operator 13).

One pass over the documents writes an inverted index to the shared folder: each task turns its documents,
in shards of bounded size, into posting lists of the terms that the queries hold. Texts are never
shuffled. Document counts, lengths and frequencies are aggregates over the shards; each shard then answers all
queries, and a window keeps the best ``top`` rows of each query.

Within a shard, a query's short lists are summed into accumulators first. The accumulators then act as one
more list, with its own bound (the largest sum), beside the long lists. Documents are visited in ascending ranges:
lists whose bounds together stay below the score of the worst result kept cannot bring a document in, so they
are not read but only looked up (by binary search) for the candidates of the others, from the largest bound
to the smallest, and a candidate that can no longer reach that score is dropped. Nothing
is approximate: scores are whole numbers, and a bound is the largest contribution of the list in the shard.

Queries are taken in blocks of ``BLOCK_TERMS`` terms, each of which costs a pass over the documents, so
what is broadcast is bounded. Every row of the query table is a query of its own, also if its id repeats or is null;
null or empty texts, of queries or documents, have no terms. Repeated documents are ranked separately, null
document ids come last among equal scores. Without documents or queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.scratch import Scratch
from barlake.llm.text import alnum_words, chunks, column, list_array, utf8

# Terms in a block of queries; documents and postings in a shard; characters tokenised at once.
BLOCK_TERMS = 500_000
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 1 << 22
SPLIT_CHARS = 2_000_000
# A list is short if it holds at most one in so many documents of its shard; documents in a range.
SHORT = 32
RANGE = 4096

SHARD = "ids array<{key}>, lengths array<bigint>, terms array<int>, ends array<int>, docs array<int>, counts array<int>"


def query_terms(queries: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item`` and its distinct ``terms`` of every query row."""
    key = queries.schema[item_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(alnum_words(t))) for t in utf8(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["item"], pa.array(terms, pa.list_(pa.binary()))], ["item", "terms"]
            )

    given = queries.select(column(item_col).alias("item"), column(text_col).cast("string").alias("text"))
    return given.mapInArrow(cut, f"item {key}, terms array<binary>").filter(F.size("terms") > 0)


class _Postings:
    """Documents of a shard under construction, and (document, term, count) of the terms looked for."""

    def __init__(self, numbers: dict[bytes, int]):
        self.numbers = numbers
        self.clear()

    def clear(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[bytes]) -> None:
        words = [alnum_words(t) for t in texts]
        lengths = list(map(len, words))
        get = self.numbers.get
        found = np.fromiter((get(w, -1) for each in words for w in each), np.int64, sum(lengths))
        owner = np.repeat(np.arange(len(texts)), lengths)[found >= 0]
        found = found[found >= 0]
        pairs, counts = np.unique(owner * len(self.numbers) + found, return_counts=True)
        first = len(self.lengths)
        self.parts.append((pairs // len(self.numbers) + first, pairs % len(self.numbers), counts))
        self.ids.append(ids)
        self.lengths += lengths
        self.size += len(pairs)

    def row(self, names: list[str]) -> pa.RecordBatch:
        """The shard, with its documents in ascending order of id and its lists by term."""
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids).to_numpy()  # nulls last
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        docs, terms, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        docs = place[docs]
        by = np.lexsort((docs, terms))
        docs, terms, counts = docs[by], terms[by], counts[by]
        distinct, starts = np.unique(terms, return_index=True)
        ends = np.concatenate((starts[1:], [len(terms)])) if len(starts) else starts
        values = [
            ids.take(pa.array(order)),
            pa.array(np.array(self.lengths, np.int64)[order]),
            *(pa.array(a, pa.int32()) for a in (distinct, ends, docs, counts)),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values], names
        )


def build_index(docs: DataFrame, numbers, doc_col: str, text_col: str) -> DataFrame:
    """Shards with the posting lists of the terms of ``numbers`` (a broadcast map from term to number)."""
    schema = SHARD.format(key=docs.schema[doc_col].dataType.simpleString())
    names = [field.split()[0] for field in schema.split(", ")]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Postings(numbers.value)
        for batch in batches:
            texts = utf8(batch["text"])
            for lo, hi in chunks([len(t) for t in texts], SPLIT_CHARS):
                shard.add(batch["id"].slice(lo, hi - lo), texts[lo:hi])
                if len(shard.lengths) >= SHARD_DOCS or shard.size >= SHARD_POSTINGS:
                    yield shard.row(names)
        if shard.lengths:
            yield shard.row(names)

    given = docs.select(column(doc_col).alias("id"), column(text_col).cast("string").alias("text"))
    return given.mapInArrow(index, schema)


def contributions(counts: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


class Shard:
    """Posting lists with the contribution of each posting, and the largest one of each list."""

    def __init__(self, row: dict[str, pa.Array], weights: np.ndarray, documents: int, total: int):
        lengths, terms, ends, docs, counts = (
            row[n].to_numpy(zero_copy_only=False).astype(np.int64)
            for n in ("lengths", "terms", "ends", "docs", "counts")
        )
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        m = 10 + (90 * lengths * documents) // total
        weight = np.repeat(weights[terms], ends - starts)
        self.docs, self.scores = docs, contributions(counts, m[docs], weight)
        self.short = max(1, len(lengths) // SHORT)
        self.lists = {t: (a, b) for t, a, b in zip(terms.tolist(), starts.tolist(), ends.tolist(), strict=True)}
        self.size = len(lengths)

    def _accumulated(self, lists: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        docs, inverse = np.unique(np.concatenate([self.docs[a:b] for a, b in lists]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, inverse, np.concatenate([self.scores[a:b] for a, b in lists]))
        return docs, sums

    def search(self, terms: list[int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """The best documents (places in the shard) and their scores, equal scores by place."""
        lists = [self.lists[t] for t in terms if t in self.lists]
        short = [x for x in lists if x[1] - x[0] <= self.short]
        iterators = [(self.docs[a:b], self.scores[a:b]) for a, b in lists if b - a > self.short]
        worst = 1  # a result needs at least this score
        if short:
            docs, sums = self._accumulated(short)
            if len(docs) >= top:
                first = np.sort(np.argpartition(-sums, top - 1)[:top])
                worst = max(worst, int(_looked_up(docs[first], sums[first].copy(), iterators).min()))
            iterators.append((docs, sums))
        iterators.sort(key=lambda x: int(x[1].max()))
        bounds = np.cumsum([int(s.max()) for _, s in iterators])
        best_docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo in range(0, self.size, RANGE):
            skipped = int(np.searchsorted(bounds, worst))  # together below the worst score kept
            if skipped == len(iterators):
                break
            docs, scores = _candidates(iterators[skipped:], lo, lo + RANGE)
            for at in range(skipped - 1, -1, -1):
                able = scores + bounds[at] >= worst
                docs, scores = docs[able], scores[able]
                scores = _looked_up(docs, scores, iterators[at : at + 1])
            able = scores >= worst
            best_docs = np.concatenate((best_docs, docs[able]))
            best = np.concatenate((best, scores[able]))
            order = np.lexsort((best_docs, -best))[:top]
            best_docs, best = best_docs[order], best[order]
            if len(best) == top:
                worst = max(worst, int(best[-1]))
        return best_docs, best


def _looked_up(docs: np.ndarray, scores: np.ndarray, iterators: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """``scores`` plus what the lists hold for these documents."""
    for listed, values in iterators:
        at = np.minimum(np.searchsorted(listed, docs), len(listed) - 1)
        scores = scores + np.where(listed[at] == docs, values[at], 0)
    return scores


def _candidates(iterators: list[tuple[np.ndarray, np.ndarray]], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a range that are in any of the lists, with their sums over these lists."""
    sums, seen = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, bool)
    for listed, values in iterators:
        a, b = np.searchsorted(listed, (lo, hi))
        places = listed[a:b] - lo
        sums[places] += values[a:b]  # a list holds a document once
        seen[places] = True
    found = np.flatnonzero(seen)
    return found + lo, sums[found]


def _statistics(shards: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and in how many documents each term of the block is."""
    lengths = F.filter("lengths", lambda n: n > 0)
    whole = shards.select(
        F.size(lengths).cast("long").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l")
    ).agg(F.sum("n"), F.sum("l"))
    documents, total = whole.first()
    each = shards.select("ends", F.posexplode("terms").alias("at", "term")).select(
        "term", (F.get("ends", "at") - F.coalesce(F.get("ends", F.col("at") - 1), F.lit(0))).alias("n")
    )
    frequencies = each.groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row for each term of the block
    return documents or 0, total or 0, {r["term"]: r["n"] for r in frequencies}


def _block(docs: DataFrame, block: list, top: int, doc_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """``query`` (place in the block), ``doc`` and ``score`` of the best documents of every shard."""
    context = docs.sparkSession.sparkContext
    vocabulary = sorted({bytes(t) for r in block for t in r["terms"]})
    numbers = {t: n for n, t in enumerate(vocabulary)}
    shards = scratch.table(build_index(docs, context.broadcast(numbers), doc_col, text_col), "postings")
    documents, total, frequency = _statistics(shards)
    weights = np.zeros(len(vocabulary), np.int64)
    for number, n in frequency.items():
        weights[number] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    queries = context.broadcast([[numbers[bytes(t)] for t in r["terms"]] for r in block])
    key = docs.schema[doc_col].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch[n].slice(i, 1).flatten() for n in batch.schema.names}
                if not total:
                    continue
                shard = Shard(row, weights, documents, total)
                found = [shard.search(terms, top) for terms in queries.value]
                number = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
                places = np.concatenate([d for d, _ in found])
                scores = np.concatenate([s for _, s in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), row["ids"].take(pa.array(places)), pa.array(scores)],
                    ["query", "doc", "score"],
                )

    return shards.mapInArrow(search, f"query int, doc {key.simpleString()}, score bigint")


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    top: int = 10,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item``, ``rank`` (from 1), ``doc`` and ``score`` of the ``top`` documents of each query."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    terms = scratch.table(query_terms(queries, item_col, item_text_col), "query-terms")
    size = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_TERMS))
    item, doc = (df.schema[name].dataType.simpleString() for df, name in ((queries, item_col), (docs, doc_col)))
    result = spark.createDataFrame([], f"item {item}, rank int, doc {doc}, score bigint")
    numbered = terms.withColumn("block", F.pmod(F.xxhash64("terms"), F.lit(blocks)))
    for number in range(blocks):
        block = numbered.filter(F.col("block") == number).drop("block").collect()  # about BLOCK_TERMS terms
        if not block:
            continue
        found = _block(docs, block, top, doc_col, text_col, scratch)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        kept = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(block)], f"query int, item {item}")
        result = result.union(kept.join(names, "query").select("item", "rank", "doc", "score"))
    result = scratch.result(result, "ranked")
    scratch.clear()
    return result
