"""Fixed-width order keys.

``min_by``/``max_by`` stay in a hash aggregate only while every buffer field has
a fixed width. A struct key does not, so several columns are packed into one
BIGINT (up to 18 digits) or one DECIMAL(38,0).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_DIGITS = 18
DECIMAL_DIGITS = 38
MS_PER_DAY = 86_400_000  # 27 bits
SEQ_BITS = 36
SOURCE_DIGITS = 17

Part = tuple[Column, int]


def _checked(part: Part) -> Column:
    """The column, or an error when it is null, negative or too wide."""
    column, digits = part
    value = column.cast("bigint")
    return F.when((value >= 0) & (value < 10**digits), value).otherwise(
        F.raise_error(F.lit(f"order key part is null or needs more than {digits} digits"))
    )


def _as_long(parts: list[Part]) -> Column:
    packed = _checked(parts[0])
    for part in parts[1:]:
        packed = packed * F.lit(10 ** part[1]).cast("bigint") + _checked(part)
    return packed


def pack_order_key(*parts: Part) -> Column:
    """One sortable number from ``(column, digits)`` parts, most significant first."""
    if sum(digits for _, digits in parts) > DECIMAL_DIGITS:
        raise ValueError(f"an order key holds at most {DECIMAL_DIGITS} digits")
    groups: list[list[Part]] = [[]]
    for part in parts:
        if part[1] > LONG_DIGITS:
            raise ValueError(f"one part holds at most {LONG_DIGITS} digits")
        if sum(digits for _, digits in groups[-1]) + part[1] > LONG_DIGITS:
            groups.append([])
        groups[-1].append(part)
    packed = _as_long(groups[0])
    if len(groups) == 1:
        return packed
    packed = packed.cast("decimal(18,0)")
    for group in groups[1:]:
        shift = Decimal(10 ** sum(digits for _, digits in group))
        packed = packed * F.lit(shift) + _as_long(group).cast("decimal(18,0)")
    return packed.cast("decimal(38,0)")


@dataclass(frozen=True)
class TickOrder:
    """A total order of the ticks of one symbol and day.

    ``key`` is what the aggregate over ticks compares. ``sources`` are columns
    that only decide between equal times: the aggregate groups by them too, so
    that ``key`` fits one BIGINT, and ``widen`` restores the full order on the
    few rows that remain.
    """

    key: Column
    sources: tuple[Part, ...] = field(default=())

    def source_columns(self) -> list[Column]:
        return [column.cast("bigint").alias(f"source_{i}") for i, (column, _) in self._numbered()]

    def source_names(self) -> list[str]:
        return [f"source_{i}" for i, _ in self._numbered()]

    def widen(self, key: str) -> Column:
        """The full order as DECIMAL(38,0): time of day, sources, low sequence bits.

        Time stands at the same digits whatever the sources are, so the keys of
        different orders compare by time.
        """
        if not self.sources:
            return F.col(key).cast("decimal(38,0)")
        sources = [(F.col(f"source_{i}"), digits) for i, (_, digits) in self._numbered()]
        unused = SOURCE_DIGITS - sum(digits for _, digits in sources)
        padding = [(F.lit(0), unused)] if unused else []
        time = (F.shiftright(key, SEQ_BITS), 8)
        low_bits = (F.col(key) % (1 << SEQ_BITS), 11)
        return pack_order_key(time, *padding, *sources, low_bits)

    def _numbered(self):
        return list(enumerate(self.sources))


def _day_key(trade_time: Column, seq: Column) -> Column:
    """Time of day in ms above the low bits of the sequence number, in one BIGINT."""
    time_of_day = F.pmod(trade_time, F.lit(MS_PER_DAY))
    value = seq.cast("bigint")
    low = F.when(value >= 0, value.bitwiseAND((1 << SEQ_BITS) - 1)).otherwise(
        F.raise_error(F.lit("order key part is null or negative"))
    )
    return F.shiftleft(time_of_day, SEQ_BITS) + low


def by_seq(trade_time: str = "trade_time", seq: str = "seq") -> TickOrder:
    """``(trade_time, seq)``, for any non-negative ``seq``."""
    number = F.col(seq).cast("bigint")
    return TickOrder(
        _day_key(F.col(trade_time), number), ((F.shiftright(number, SEQ_BITS), 9),)
    )


def by_offset(topics: list[str]) -> TickOrder:
    """``(trade_time, topic, partition, offset)`` for bronze ticks."""
    position = F.array_position(F.array(*[F.lit(t) for t in sorted(topics)]), F.col("topic"))
    # A topic outside the list gives 0, which must not pass as a position.
    topic = F.when(position > 0, position)
    offset = F.col("offset").cast("bigint")
    return TickOrder(
        _day_key(F.col("trade_time"), offset),
        ((topic, 2), (F.col("partition"), 6), (F.shiftright(offset, SEQ_BITS), 9)),
    )
