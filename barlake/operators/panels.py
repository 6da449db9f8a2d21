"""Dashboard queries and long-range summaries (O-1..O-5, A-8, A-9, F-7, F-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.bars import symbol_window


def in_range(rows: DataFrame, start: str | None, end: str | None, day: str = "fetch_date"):
    """Optional closed date range."""
    if start is not None:
        rows = rows.filter(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col(day) <= F.lit(end).cast("date"))
    return rows


# The column names of the panels are fixed values.


def price_panel(gold: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """O-1: close price over time."""
    return (
        in_range(gold, start, end)
        .select(
            F.col("fetch_date").cast("timestamp_ntz").alias("time"),
            F.col("close_price").alias("Close Price"),
            "symbol",
        )
        .orderBy("time", "symbol")
    )


def volume_panel(gold: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """O-2: volume over time, with its logarithm for the log-scale axis."""
    volume = F.col("volume")
    return (
        in_range(gold, start, end)
        .select(
            F.col("fetch_date").cast("timestamp_ntz").alias("time"),
            volume.alias("Volume"),
            F.when(volume > 0, F.log10(volume.cast("double"))).alias("log10_volume"),
            "symbol",
        )
        .orderBy("time", "symbol")
    )


def latest_prices(gold: DataFrame, n: int = 100) -> DataFrame:
    """O-3: the newest rows of the serving table."""
    return (
        gold.orderBy(F.desc("fetch_date"), F.asc("symbol"))
        .limit(n)
        .select(
            F.col("symbol").alias("Symbol"),
            F.col("fetch_date").alias("Date"),
            F.col("open_price").alias("Open"),
            F.col("high_price").alias("High"),
            F.col("low_price").alias("Low"),
            F.col("close_price").alias("Close"),
            F.col("volume").alias("Volume"),
            F.col("currency").alias("Currency"),
            F.col("asset_type").alias("Asset Type"),
        )
    )


def latest_indicators(indicators: DataFrame, n: int = 50) -> DataFrame:
    """O-4: the newest windows; equal starts are ordered by symbol."""
    return indicators.orderBy(F.desc("window_start"), F.asc("symbol")).limit(n)


def preview(rows: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """O-5: a few rows, the same ones every time when ``order`` is given."""
    return (rows.orderBy(*order) if order else rows).limit(n)


def symbol_history(
    rows: DataFrame, symbol: str, as_of: Column, days: int = 30, day: str = "fetch_date"
) -> DataFrame:
    """F-8: one symbol over the trailing days before ``as_of``."""
    return rows.filter((F.col("symbol") == symbol) & (F.col(day) >= F.date_sub(as_of, days)))


def period_prices(bars: DataFrame, period: str) -> DataFrame:
    """A-8: mean close and volume per symbol and week, month or year."""
    return bars.groupBy(
        "symbol", F.to_date(F.date_trunc(period, "fetch_date")).alias("period_start")
    ).agg(
        F.avg("close_price").alias("avg_close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("bars"),
    )


def volume_rollup(bars: DataFrame) -> DataFrame:
    """A-8: volume by symbol, year and month with subtotals.

    Only the totals carry null keys; ``level`` tells them apart from data.
    """
    return (
        bars.withColumns({"year": F.year("fetch_date"), "month": F.month("fetch_date")})
        .rollup("symbol", "year", "month")
        .agg(
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("bars"),
            F.grouping_id().cast("int").alias("level"),
        )
    )


def cumulative_volume(bars: DataFrame) -> DataFrame:
    """A-8: running volume per symbol over months."""
    monthly = bars.groupBy(
        "symbol", F.to_date(F.date_trunc("month", "fetch_date")).alias("month_start")
    ).agg(F.sum("volume").alias("volume"))
    running = symbol_window("month_start").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("cumulative_volume", F.sum("volume").over(running))


def market_summary(bars: DataFrame) -> DataFrame:
    """A-9: per day the symbols, volume, mean return, best and worst symbol.

    Equal returns: the best is the last symbol in order, the worst the first.
    """
    ranked = F.struct("daily_return", "symbol")
    return bars.groupBy("fetch_date").agg(
        F.count(F.lit(1)).alias("symbols"),
        F.sum("volume").alias("total_volume"),
        F.avg("daily_return").alias("mean_return"),
        F.max(ranked)["symbol"].alias("best_symbol"),
        F.min(ranked)["symbol"].alias("worst_symbol"),
    )
