"""Scalar expressions shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 9999-12-31T23:59:59.999Z, the last millisecond the date functions accept.
MAX_EPOCH_MS = 253_402_300_799_999


def event_time(trade_time: str = "trade_time") -> Column:
    """Epoch milliseconds to TIMESTAMP."""
    return F.timestamp_millis(F.col(trade_time))


def trade_date(trade_time: str = "trade_time") -> Column:
    """F-3: the UTC date of an epoch-millisecond column (session zone is UTC)."""
    return F.to_date(event_time(trade_time))


def date_key(date: Column) -> Column:
    """yyyymmdd as INT."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_key(key: Column) -> Column:
    """yyyymm of a yyyymmdd key; the fact table is partitioned by it."""
    return F.floor(key / 100).cast("int")


def date_of_key(key: Column) -> Column:
    """DATE of a yyyymmdd key."""
    return F.make_date(
        F.floor(key / 10000).cast("int"),
        F.floor(key % 10000 / 100).cast("int"),
        (key % 100).cast("int"),
    )


def guarded_percent(numerator: Column, base: Column) -> Column:
    """F-6: ``numerator / base * 100`` when the base is positive, else 0.0."""
    return F.when(base > 0, numerator / base * 100).otherwise(0.0)


def vwap_of(sum_price_quantity: Column, sum_quantity: Column, mean_price: Column) -> Column:
    """A-5: volume-weighted mean, or the plain mean when nothing was traded."""
    return F.when(sum_quantity > 0, sum_price_quantity / sum_quantity).otherwise(mean_price)


def is_bad_price(price: Column) -> Column:
    """True for null, NaN, infinite, zero or negative prices."""
    finite = F.coalesce(
        ~F.isnan(price) & (F.abs(price) < F.lit(float("inf"))) & (price > 0), F.lit(False)
    )
    return ~finite


def is_bad_quantity(quantity: Column) -> Column:
    """True for NaN, infinite or negative quantities; null counts as zero volume."""
    bad = F.isnan(quantity) | (F.abs(quantity) == F.lit(float("inf"))) | (quantity < 0)
    return F.coalesce(bad, F.lit(False))


def is_bad_time(trade_time: Column) -> Column:
    return F.coalesce(~trade_time.between(0, MAX_EPOCH_MS), F.lit(True))
