"""Exact integer k-means over dictionary-encoded subvectors (operator 12).

Vectors are scaled to integers and cut into blocks of ``width`` dimensions. Chunks of vectors are stored
once, in the shared folder, as columns: for each block the distinct subvectors of the chunk and every
vector's code, which loses nothing. A round computes the squared distance of each distinct subvector to the
centroids once, and a vector's distance is the sum of its codes' partial distances. The sums that
make the next centroids come from counts of codes as well. Vectors are never shuffled: a round is one
pass over the chunks and an aggregate of a row for each cluster and task, and only these ``k`` rows reach
the driver. Memory is bounded by a chunk, however often one vector repeats.

All arithmetic is in 64-bit integers; components beyond ``LIMIT`` could overflow it and raise an error.
Vectors of another length, or with a null, NaN or infinite component, are left out, as are null
vectors. The ``k`` vectors first by hash start as centroids, fewer if there are fewer; equal hashes (repeated ids)
are ordered by their vectors, null ids come last. Ties go to the smaller cluster number, empty clusters keep
their centroid, an empty table gives an empty result, and every repeated row is a vector of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import Scratch
from barlake.llm.text import column

# Vectors in a chunk, and the largest integer component.
CHUNK_ROWS = 1 << 16
LIMIT = 1 << 27

CHUNK = "ids array<{key}>, starts array<int>, dictionary array<int>, codes array<int>"


@dataclass
class Blocks:
    """A chunk: ``dictionary`` holds the distinct subvectors of all blocks, ``codes`` a row of each block."""

    starts: np.ndarray
    dictionary: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, width: int) -> Blocks:
        found, codes, starts = [], [], [0]
        for at in range(0, vectors.shape[1], width):
            part = vectors[:, at : at + width]
            code = np.zeros(len(part), np.int64)
            for values in part.T:
                distinct, inverse = np.unique(values, return_inverse=True)
                _, first, code = np.unique(
                    code * len(distinct) + inverse, return_index=True, return_inverse=True
                )
            found.append(part[first])
            codes.append(code)
            starts.append(starts[-1] + len(first))
        flat = np.zeros((starts[-1], width), np.int64)
        for lo, part in zip(starts, found, strict=False):
            flat[lo : lo + len(part), : part.shape[1]] = part  # a narrower last block is filled with zeros
        return cls(np.array(starts), flat, np.array(codes))

    @classmethod
    def read(cls, row: dict[str, pa.Array], width: int) -> Blocks:
        starts, dictionary, codes = (
            row[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("starts", "dictionary", "codes")
        )
        return cls(starts, dictionary.reshape(-1, width), codes.reshape(len(starts) - 1, -1))

    def _parts(self, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Codes, subvectors and centroid parts of each block."""
        width = self.dictionary.shape[1]
        blocks = len(self.codes)
        padded = np.zeros((len(centroids), blocks * width), np.int64)
        padded[:, : centroids.shape[1]] = centroids
        for b in range(blocks):
            subvectors = self.dictionary[self.starts[b] : self.starts[b + 1]]
            yield self.codes[b], subvectors, padded[:, b * width : (b + 1) * width]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, the smallest number among equals, and its squared distance."""
        total = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for codes, subvectors, part in self._parts(centroids):
            partial = ((subvectors[:, None, :] - part[None]) ** 2).sum(axis=2)
            total += partial[codes]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int, dims: int) -> np.ndarray:
        """The sum of each cluster's vectors, from how often each of their codes occurs."""
        out = []
        for b, codes in enumerate(self.codes):
            subvectors = self.dictionary[self.starts[b] : self.starts[b + 1]]
            m = len(subvectors)
            out.append(np.bincount(cluster * m + codes, minlength=k * m).reshape(k, m) @ subvectors)
        return np.concatenate(out, axis=1)[:, :dims]


def whole_vectors(
    df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int
) -> DataFrame:
    """``id`` and ``v`` (the integers) of every vector that is kept."""
    vector = column(vector_col)

    def usable(x: Column) -> Column:
        number = x.cast("double")
        return x.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))

    kept = df.filter((F.size(vector) == dims) & F.forall(vector, usable))

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * F.lit(float(scale)))
        too_large = F.abs(x.cast("double")) * F.lit(float(scale)) >= F.lit(float(LIMIT))
        return F.when(too_large, F.raise_error(F.lit(f"a component beyond {LIMIT // scale}"))).otherwise(value).cast("int")

    return kept.select(column(id_col).alias("id"), F.transform(vector, whole).alias("v"))


def encoded_chunks(vectors: DataFrame, dims: int, width: int) -> DataFrame:
    key = vectors.schema["id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def row(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(batches).combine_chunks()
            flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["v"].chunks])
            blocks = Blocks.of(flat.reshape(-1, dims).astype(np.int64), width)
            ids = pa.concat_arrays(table["id"].chunks)
            parts = [ids, *(pa.array(a.ravel(), pa.int32()) for a in (blocks.starts, blocks.dictionary, blocks.codes))]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in parts]
            return pa.RecordBatch.from_arrays(lists, ["ids", "starts", "dictionary", "codes"])

        for batch in batches:
            while batch.num_rows:
                room = CHUNK_ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(held[-1].num_rows)
                if sum(b.num_rows for b in held) == CHUNK_ROWS:
                    yield row(held)
                    held = []
        if held:
            yield row(held)

    return vectors.mapInArrow(encode, CHUNK.format(key=key.simpleString()))


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
    for i in range(batch.num_rows):
        yield {n: batch[n].slice(i, 1).flatten() for n in batch.schema.names}


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def next_round(chunks: DataFrame, centroids: np.ndarray, width: int) -> dict[int, tuple[int, int, list[int]]]:
    """Number of vectors, summed distance and summed components of each cluster that has vectors."""
    k, dims = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inertia, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for row in _rows(batch):
                blocks = Blocks.read(row, width)
                cluster, distance = blocks.nearest(centroids)
                counts += np.bincount(cluster, minlength=k)
                np.add.at(inertia, cluster, distance)
                sums += blocks.sums(cluster, k, dims)
        some = np.flatnonzero(counts)
        flat = pa.array(sums[some].ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dims, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(inertia[some]), lists],
            ["cluster", "n", "inertia", "sums"],
        )

    each = chunks.mapInArrow(assign, "cluster int, n bigint, inertia bigint, sums array<bigint>")
    totals = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    rows = each.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), *totals).collect()
    return {r["cluster"]: (r["n"], r["inertia"], [r[f"s{i}"] for i in range(dims)]) for r in rows}


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    width: int = 2,
    seed: str = "3",
) -> DataFrame:
    """``id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each vector."""
    vectors = whole_vectors(df, id_col, vector_col, dims, scale)
    key = vectors.schema["id"].dataType.simpleString()
    result = "id {}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], result.format(key))
    chunks = Scratch(df.sparkSession).result(encoded_chunks(vectors, dims, width), "subvectors")
    found = next_round(chunks, centroids, width)
    for _ in range(rounds):
        moved = centroids.copy()
        for number, (n, _, sums) in found.items():
            moved[number] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # every further round would repeat this one
        centroids = moved
        found = next_round(chunks, centroids, width)
    inertia = {number: each for number, (_, each, _) in found.items()}
    total = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_cluster = np.array([inertia.get(i, 0) for i in range(len(digests))], np.int64)
        for batch in batches:
            for row in _rows(batch):
                number, distance = Blocks.read(row, width).nearest(centroids)
                names = pa.DictionaryArray.from_arrays(pa.array(number, pa.int32()), pa.array(digests))
                yield pa.RecordBatch.from_arrays(
                    [
                        row["ids"],
                        pa.array(number, pa.int32()),
                        pa.array(distance),
                        pa.array(per_cluster[number]),
                        pa.array(np.full(len(number), total, np.int64)),
                        names.cast(pa.string()),
                    ],
                    ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return chunks.mapInArrow(final, result.format(key))
