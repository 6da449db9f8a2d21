"""Words, hashes and Arrow batches as the corpus operators share them.

Texts are handled as UTF-8 bytes: ``bytes.split`` cuts at exactly the six ASCII
white-space characters, and ``bytes.lower`` changes A-Z only. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower-cases A-Z and turns every other ASCII character that is no digit or letter into a space.
ALNUM_TABLE = bytes(
    ord(chr(c).lower()) if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(128)
) + bytes(range(128, 256))


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(values: pa.Array) -> list[bytes]:
    binary = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [b or b"" for b in values.cast(binary).to_pylist()]


def alnum_words(text: bytes) -> list[bytes]:
    """Words of digits, a-z (lower-cased) and everything beyond ASCII."""
    return text.translate(ALNUM_TABLE).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values."""
    return next(out for _, out in rollings(values, [size]))


def rollings(values: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """``rolling`` for several sizes in ascending order, each going on from the one before."""
    out, done = np.zeros(len(values), np.uint64), 0
    for size in sizes:
        out = out[: max(0, len(values) - size + 1)].copy()
        for shift in range(done, size):
            out *= _PRIME
            out += values[shift : shift + len(out)]
        done = size
        yield size, mixed(out)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def cover(length: int, starts: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """True for each place that an interval of ``size`` from one of ``starts`` covers."""
    marks = np.zeros(length + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + size, length), -1)
    return np.cumsum(marks[:-1]) > 0


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows into consecutive ranges of about ``limit`` in size, a row at least."""
    first = total = 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, row
            first, total = row, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
