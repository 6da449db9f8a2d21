"""MinHash near-duplicates with HyperMinHash sketches (operator 5).

Each document's set of word shingles is hashed once. The hash space is cut into buckets, and
a bucket's register holds the leading zeros of its smallest hash and the bits after them. Groups of
four registers are the bands: documents that agree in a band are candidates.

Work stays in proportion to the documents, however large a group of copies is:

1. Documents with equal sets are one node, found by a fingerprint of the set.
2. In every band bucket, each node is compared with the smallest one and with the node before it
   (in parts of a bounded size), not with all. The registers give an estimate of the Jaccard
   similarity, corrected for chance collisions; pairs that it clearly excludes go, and the full sets
   decide on the others. The links found give components.
3. Only nodes outside the largest component of their bucket are then compared with the
   bucket's nodes of other components, register against register in blocks of a bounded size; texts
   follow to the blocks that have candidates, where the full sets decide. Pairs inside one
   component need no check, so no link that joins components is lost.

With 32 bands of 4 registers a pair at similarity 0.8 shares no band with probability below 1e-7;
the estimate excludes pairs only five standard errors under the threshold.

Nulls and texts without words have an empty set and link nothing. A row without key links nothing
and has no component. Rows that repeat a key count as one document for links, each with its own size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.components import connected_components
from barlake.llm.scratch import Scratch
from barlake.llm.text import column, mixed, rolling, utf8, word_hashes

BANDS, ROWS = 32, 4
REGISTER_BITS = 8
MANTISSA_BITS = 10
EMPTY = 0xFFFF
MARGIN = 5.0
# Nodes of a bucket in one chain, and in one block of the comparison of leftovers.
PART = 1000
BLOCK = 512


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < size:
        return rolling(hashes, len(words)) ^ np.uint64(len(words))
    return np.unique(rolling(hashes, size))


def registers(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HyperMinHash registers: leading zeros and mantissa of the smallest hash of each bucket."""
    buckets = np.arange(1 << bits, dtype=np.uint64)
    first = np.searchsorted(hashes, buckets << np.uint64(64 - bits))
    value = hashes[np.minimum(first, len(hashes) - 1)]
    filled = (first < len(hashes)) & (value >> np.uint64(64 - bits) == buckets)
    rest = (value << np.uint64(bits)) | np.uint64((1 << bits) - 1)
    zeros = (64 - np.frexp(rest.astype(np.float64))[1]).clip(0, 62).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    return np.where(filled, (zeros << np.uint64(MANTISSA_BITS)) | mantissa, EMPTY).astype(np.uint16)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band, 0 where all of a band's registers are empty."""
    packed = registers(hashes, (BANDS * ROWS).bit_length() - 1).reshape(BANDS, ROWS).view(np.uint64).ravel()
    keys = mixed(packed ^ mixed(np.arange(1, BANDS + 1, dtype=np.uint64)))
    return np.where(packed == np.uint64(2**64 - 1), 0, keys.view(np.int64))


def estimates(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of one register row against many, and their errors."""
    either = ((one != EMPTY) | (many != EMPTY)).sum(axis=-1).clip(1)
    equal = ((one == many) & (one != EMPTY)).sum(axis=-1)
    chance = 2.0**-MANTISSA_BITS / 3
    jaccard = ((equal / either - chance) / (1 - chance)).clip(0, 1)
    return jaccard, 1 / np.sqrt(either)


def possible(one: np.ndarray, many: np.ndarray, percent: float) -> np.ndarray:
    jaccard, error = estimates(one, many)
    wanted = percent / 100
    return jaccard >= wanted - MARGIN * np.sqrt(wanted * (1 - wanted)) * error


def _sketches(rows: DataFrame, size: int, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, prints, bands, sketches = [], [], [], []
            for text in utf8(batch["text"]):
                hashes = shingle_set(text, size)
                counts.append(len(hashes))
                prints.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(band_keys(hashes) if len(hashes) else None)
                sketches.append(registers(hashes, REGISTER_BITS).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(counts, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["id", "n", "print", "bands", "registers"],
            )

    return rows.mapInArrow(run, f"id {key}, n long, print binary, bands array<bigint>, registers binary")


def _pair_filter(pairs: DataFrame, keep, key: str, *columns: str) -> DataFrame:
    """Pairs (a, b) for which ``keep`` of the two sides' columns is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(keep(*(batch[c] for c in columns)), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"]
            )

    return pairs.select("a", "b", *columns).mapInArrow(run, f"a {key}, b {key}")


def _sides(pairs: DataFrame, nodes: DataFrame, value: str) -> DataFrame:
    left = nodes.select(F.col("id").alias("a"), F.col(value).alias("left"))
    right = nodes.select(F.col("id").alias("b"), F.col(value).alias("right"))
    return pairs.join(left, "a").join(right, "b")


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: float, key: str) -> DataFrame:
    def keep(left: pa.Array, right: pa.Array) -> np.ndarray:
        one, many = (
            np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, 1 << REGISTER_BITS)
            for x in (left, right)
        )
        return possible(one, many, percent)

    return _pair_filter(_sides(pairs, nodes, "registers"), keep, key, "left", "right")


def _verified(pairs: DataFrame, nodes: DataFrame, size: int, percent: float, key: str) -> DataFrame:
    def keep(left: pa.Array, right: pa.Array) -> list[bool]:
        known: dict[bytes, np.ndarray] = {}

        def hashes(text: bytes) -> np.ndarray:
            if text not in known:
                if len(known) > 64:
                    known.clear()
                known[text] = shingle_set(text, size)
            return known[text]

        out = []
        for one, two in zip(utf8(left), utf8(right), strict=True):
            a, b = hashes(one), hashes(two)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * shared >= percent * (len(a) + len(b) - shared))
        return out

    return _pair_filter(_sides(pairs, nodes, "text"), keep, key, "left", "right").distinct()


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each member with the smallest of its bucket, and with the one before it in its part."""
    star = members.filter("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / PART))
    order = Window.partitionBy("key", part).orderBy("id")
    chain = members.select(F.lag("id").over(order).alias("a"), F.col("id").alias("b")).filter("a != b")
    return star.union(chain).distinct()


def _left_over(
    members: DataFrame, labels: DataFrame, nodes: DataFrame, size: int, percent: float, key: str
) -> DataFrame:
    """Links between different components whose nodes share a bucket.

    Buckets of up to three nodes have had all their pairs compared already.
    """
    labelled = members.filter("size > 3").join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("size"), F.count("*").alias("parts")
    )
    top = top.filter("parts > 1").select(
        "key",
        F.col("top.component").alias("main"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("other_blocks"),
    )
    rows = labelled.join(top, "key").join(nodes.select("id", "bands", "registers"), "id")

    def of(n: str, seed: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = ["key", "id", "component", "bands", "registers"]
    against = rows.select(*columns, F.lit(0).alias("role"), (F.col("component") != F.col("main")).alias("other"), of("blocks", 1).alias("j"), every("other_blocks").alias("i"))
    asking = rows.filter("component != main").select(
        *columns, F.lit(1).alias("role"), F.lit(True).alias("other"), every("blocks").alias("j"), of("other_blocks", 2).alias("i")
    )
    blocks = (
        against.unionByName(asking)
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "role")
        .select(*columns, "role", "other", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ["key", "i", "j"]):
            yield from _compare(block, percent)

    schema = f"key long, i int, j int, id {key}, component {key}, a array<{key}>, b array<{key}>"
    found = blocks.mapInArrow(run, schema)
    # Texts go to the blocks that have candidates, once per document and block.
    texts = nodes.select("id", "text")
    asked = (
        found.join(texts, "id", "left")
        .select("key", "i", "j", "id", "component", "text", "a", "b")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ["key", "i", "j"]):
            yield from _confirm(block, size, percent)

    return asked.mapInArrow(check, f"a {key}, b {key}").distinct()


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, which may go over the end of a batch."""
    waiting: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        arrays = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for values in arrays:
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi == lo:
                continue
            now = tuple(values[lo] for values in arrays)
            if waiting and now != last:
                yield pa.concat_tables(waiting).combine_chunks()
                waiting = []
            waiting.append(table.slice(lo, hi - lo))
            last = now
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks()


def _compare(block: pa.Table, percent: float) -> Iterator[pa.RecordBatch]:
    """Pairs of a block that may be similar: one row with all of them, and one for each node in them."""
    role = block["role"].to_numpy()
    n_against = int((role == 0).sum())
    if n_against in (0, len(role)):
        return
    key = block["key"][0].as_py()
    ids = block["id"].combine_chunks()
    component = block["component"].combine_chunks()
    codes = component.dictionary_encode().indices.to_numpy()
    order = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64)
    sketch = np.frombuffer(b"".join(block["registers"].to_pylist()), np.uint16).reshape(len(role), -1)
    bands = np.array(block["bands"].to_pylist(), np.int64)
    other = block["other"].to_numpy(zero_copy_only=False)[:n_against]
    left, right = [], []
    for row in range(n_against, len(role)):
        # Two leftovers meet once only, and a pair is taken in the first band it shares.
        wanted = (codes[:n_against] != codes[row]) & (~other | (order[:n_against] > order[row]))
        at = np.flatnonzero(wanted)
        at = at[possible(sketch[row], sketch[at], percent)]
        if len(at):
            shared = (bands[at] == bands[row]) & (bands[row] != 0)
            at = at[bands[row][shared.argmax(axis=1)] == key]
            left += [row] * len(at)
            right += at.tolist()
    if not left:
        return
    used = pa.array(sorted({*left, *right}), pa.int64())
    n = len(used) + 1
    place = [pa.repeat(block[c].combine_chunks()[0], n) for c in ("key", "i", "j")]
    kind = pa.list_(ids.type)
    pairs = [
        pa.concat_arrays([pa.nulls(n - 1, kind), pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), ids.take(pa.array(x)))])
        for x in (left, right)
    ]
    own = [pa.concat_arrays([x.take(used), pa.nulls(1, x.type)]) for x in (ids, component)]
    yield pa.RecordBatch.from_arrays([*place, *own, *pairs], ["key", "i", "j", "id", "component", "a", "b"])


def _confirm(block: pa.Table, size: int, percent: float) -> Iterator[pa.RecordBatch]:
    """Links of a block by the full sets, one for each node and component it is linked with."""
    block = block.combine_chunks()
    rows = {k: n for n, k in enumerate(block["id"].to_pylist()) if k is not None}
    components = block["component"].to_pylist()
    texts = utf8(block["text"].combine_chunks())
    sets: dict[int, np.ndarray] = {}

    def hashes(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = shingle_set(texts[row], size)
        return sets[row]

    left, right, linked = [], [], set()
    for one, two in zip(block["a"].to_pylist(), block["b"].to_pylist(), strict=True):
        for a, b in zip(one or (), two or (), strict=True):
            i, j = rows[a], rows[b]
            if (a, components[j]) in linked:
                continue
            x, y = hashes(i), hashes(j)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                linked.add((a, components[j]))
                left.append(a)
                right.append(b)
    if left:
        kind = block["id"].type
        yield pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind)], ["a", "b"])


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: float = 80, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document row: ``id``, ``n_shingles``, ``component_id`` (the smallest id linked with it)."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(column(key_col).alias("id"), column(text_col).alias("text"))
    key = rows.schema["id"].dataType.simpleString()
    sketches = scratch.table(_sketches(rows, size, key), "sketches")

    prints = sketches.filter("n > 0 and id is not null").groupBy("print").agg(F.min("id").alias("node"))
    owned = sketches.select("id", "n", "print").join(prints, "print", "left")
    documents = scratch.result(owned.select("id", "n", F.coalesce("node", "id").alias("node")), "documents")
    chosen = prints.select(F.col("node").alias("id")).distinct()
    nodes = sketches.filter("n > 0").select("id", "bands").join(chosen, "id", "left_semi")

    buckets = nodes.select("id", F.explode("bands").alias("key")).filter("key != 0").distinct()
    shared = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("first")).filter("size > 1")
    members = scratch.table(buckets.join(shared, "key"), "members")
    involved = members.select("id").distinct()
    # One text per node: rows that repeat a key would multiply pairs.
    texts = rows.join(involved, "id", "left_semi").withColumnRenamed("text", "t")
    texts = texts.groupBy("id").agg(F.min("t").alias("text"))
    own = sketches.select("id", "bands", "registers").join(involved, "id", "left_semi").filter("bands is not null")
    own = own.dropDuplicates(["id"])
    nodes = scratch.table(texts.join(own, "id"), "nodes")

    first = scratch.table(_first_pairs(members), "pairs")
    tried = _estimated(first, nodes, percent, key)
    links = scratch.table(_verified(tried, nodes, size, percent, key), "links")
    labels = connected_components(links)

    more = scratch.table(_left_over(members, labels, nodes, size, percent, key), "left-over")
    ends = [
        labels.select(F.col("id").alias(side), F.col("component").alias(f"component_{side}")) for side in "ab"
    ]
    bridges = more.join(ends[0], "a", "left").join(ends[1], "b", "left")
    bridges = bridges.select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b"))
    joined = connected_components(bridges)

    final = labels.select(F.col("id").alias("node"), "component")
    whole = documents.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = whole.join(
        joined.select(F.col("id").alias("component"), F.col("component").alias("wider")), "component", "left"
    )
    scratch.clear()
    return whole.select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("wider", "component").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: float = 80, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the smallest of their group, all their columns unchanged.

    Rows that repeat a kept key stay, as do rows without key.
    """
    linked = near_duplicates(docs, size, percent, key_col, text_col)
    gone = linked.filter("id != component_id").select(F.col("id").alias("__gone")).distinct()
    return docs.join(gone, column(key_col) == F.col("__gone"), "left_anti")
