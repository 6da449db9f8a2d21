"""A wavelet matrix over token ids: bit planes with rank and select."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMX1"
# Bits between two stored counts of ones.
STEP = 512


class WaveletMatrix:
    """A sequence of whole numbers as bit planes, the highest bit first.

    Each plane holds one bit of every value; below it, the values with a 0 come before those with a 1,
    both in their order. ``rank`` counts on a plane use a stored count every ``STEP`` bits.
    """

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int]):
        self.size, self.planes, self.zeros = size, planes, zeros
        self._counts: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, values: np.ndarray, levels: int) -> WaveletMatrix:
        planes, zeros = [], []
        for level in reversed(range(levels)):
            ones = values & values.dtype.type(1 << level) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            low = values[~ones]
            zeros.append(len(low))
            values = np.concatenate((low, values[ones]))
        return cls(len(values), planes, zeros)

    def values(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        out = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for bit, plane in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane, count=self.size, bitorder="little").view(bool)
            zeros = self.zeros[len(self.planes) - 1 - bit]
            above = np.empty_like(out)
            above[~ones] = out[:zeros]
            above[ones] = out[zeros:] | out.dtype.type(1 << bit)
            out = above
        return out

    def _ones(self, level: int, end: int) -> int:
        """Ones before ``end`` on a plane."""
        counts = self._counts[level]
        if counts is None:
            bits = np.unpackbits(self.planes[level], bitorder="little")
            bits = np.concatenate((bits, np.zeros(-len(bits) % STEP, np.uint8)))
            sums = bits.reshape(-1, STEP).sum(axis=1, dtype=np.int64)
            counts = self._counts[level] = np.concatenate(([0], np.cumsum(sums)))
        block = end // STEP
        rest = np.unpackbits(self.planes[level][block * STEP // 8 : (end + 7) // 8], bitorder="little")
        return int(counts[block]) + int(rest[: end - block * STEP].sum())

    def _bit(self, level: int, place: int) -> int:
        return int(self.planes[level][place >> 3]) >> (place & 7) & 1

    def _down(self, level: int, bit: int, place: int) -> int:
        ones = self._ones(level, place)
        return self.zeros[level] + ones if bit else place - ones

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, place)
            value = value << 1 | bit
            place = self._down(level, bit, place)
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a value before ``end`` lie below the last plane."""
        lo, hi = 0, end
        for level in range(len(self.planes)):
            bit = value >> (len(self.planes) - 1 - level) & 1
            lo, hi = self._down(level, bit, lo), self._down(level, bit, hi)
        return lo, hi

    def rank(self, value: int, end: int) -> int:
        """Occurrences of a value before ``end``."""
        if value >> len(self.planes):
            return 0
        lo, hi = self._range(value, min(end, self.size))
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.size)

    def select(self, value: int, number: int) -> int:
        """The place of the occurrence with this number, from 0."""
        if value >> len(self.planes) or not 0 <= number < self.count(value):
            raise IndexError(number)
        place = self._range(value, self.size)[0] + number
        for level in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - level) & 1
            nth = place - self.zeros[level] if bit else place
            lo, hi = 0, self.size
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if bit else mid + 1 - ones) <= nth:
                    lo = mid + 1
                else:
                    hi = mid
            place = lo
        return place

    def places(self, value: int) -> list[int]:
        return [self.select(value, n) for n in range(self.count(value))]

    def to_bytes(self) -> bytes:
        """The file: magic, size, levels, zeros of each level, then the compressed planes."""
        head = struct.pack(f"<QI{len(self.zeros)}Q", self.size, len(self.planes), *self.zeros)
        return MAGIC + head + zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in self.planes))

    @classmethod
    def from_bytes(cls, content: bytes) -> WaveletMatrix:
        if content[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size, levels = struct.unpack_from("<QI", content, 4)
        zeros = list(struct.unpack_from(f"<{levels}Q", content, 16))
        raw = zstandard.ZstdDecompressor().decompress(content[16 + 8 * levels :], max_output_size=levels * (size + 7) // 8 + 8 * levels)
        width = (size + 7) // 8
        flat = np.frombuffer(raw, np.uint8)
        return cls(size, [flat[i * width : (i + 1) * width] for i in range(levels)], zeros)
