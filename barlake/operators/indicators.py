"""Indicators over ticks (T-4 in batch, A-4..A-6) and over bars (W-6..W-15)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.scalars import event_time, vwap_of
from barlake.operators.bars import symbol_window

# --- over ticks ---------------------------------------------------------------


def _window_columns() -> list[Column]:
    mean = F.try_divide("sum_price", "priced")
    return [
        F.col("symbol"),
        F.col("window_start"),
        F.col("window_end"),
        mean.alias("sma"),
        vwap_of(F.col("sum_price_quantity"), F.col("sum_quantity"), mean).alias("vwap"),
        F.col("priced").cast("int").alias("trade_count"),
    ]


def sliding_indicators(
    ticks: DataFrame, width_seconds: int = 60, slide_seconds: int = 10
) -> DataFrame:
    """T-4: SMA, VWAP and trade count per symbol and sliding window.

    Ticks are first summed into panes of one slide, then each pane is added to
    the windows it lies in. Ticks are therefore read and combined once, not once
    per overlapping window.
    """
    if width_seconds % slide_seconds:
        raise ValueError("the window width must be a multiple of the slide")
    second = F.unix_seconds(event_time())
    panes = (
        ticks.withColumn("pane", second - F.pmod(second, F.lit(slide_seconds)))
        .groupBy("symbol", "pane")
        .agg(
            F.sum("price").alias("sum_price"),
            F.count("price").alias("priced"),
            F.sum(F.col("price") * F.col("quantity")).alias("sum_price_quantity"),
            F.sum("quantity").alias("sum_quantity"),
        )
    )
    starts = F.sequence(
        F.col("pane") - (width_seconds - slide_seconds), F.col("pane"), F.lit(slide_seconds)
    )
    windows = (
        panes.withColumn("start", F.explode(starts))
        .groupBy("symbol", "start")
        .agg(
            *[
                F.sum(name).alias(name)
                for name in ("sum_price", "priced", "sum_price_quantity", "sum_quantity")
            ]
        )
        .withColumn("window_start", F.timestamp_seconds("start"))
        .withColumn("window_end", F.timestamp_seconds(F.col("start") + width_seconds))
    )
    return windows.select(*_window_columns())


def window_aggregates(
    ticks: DataFrame, width: str = "1 minute", slide: str = "10 seconds"
) -> DataFrame:
    """T-4 with ``window()``, for streams: one stateful aggregate.

    ``ticks`` needs ``event_time``.
    """
    return (
        ticks.groupBy("symbol", F.window("event_time", width, slide).alias("w"))
        .agg(
            F.sum("price").alias("sum_price"),
            F.count("price").alias("priced"),
            F.sum(F.col("price") * F.col("quantity")).alias("sum_price_quantity"),
            F.sum("quantity").alias("sum_quantity"),
        )
        .withColumn("window_start", F.col("w.start"))
        .withColumn("window_end", F.col("w.end"))
        .select(*_window_columns())
    )


def pane_aggregates(
    ticks: DataFrame, width: str = "1 minute", slide: str = "10 seconds"
) -> DataFrame:
    """T-4 as two aggregates in a row, for streams in append mode: panes, then windows over panes.

    A tick enters one pane, and a pane, not each of its ticks, enters the windows it lies in. The
    width must be a multiple of the slide. ``ticks`` needs ``event_time``.
    """
    panes = (
        ticks.groupBy("symbol", F.window("event_time", slide).alias("pane"))
        .agg(
            F.sum("price").alias("sum_price"),
            F.count("price").alias("priced"),
            F.sum(F.col("price") * F.col("quantity")).alias("sum_price_quantity"),
            F.sum("quantity").alias("sum_quantity"),
        )
        .withColumn("pane_time", F.window_time("pane"))
    )
    sums = ["sum_price", "priced", "sum_price_quantity", "sum_quantity"]
    return (
        panes.groupBy("symbol", F.window("pane_time", width, slide).alias("w"))
        .agg(*[F.sum(name).alias(name) for name in sums])
        .withColumn("window_start", F.col("w.start"))
        .withColumn("window_end", F.col("w.end"))
        .select(*_window_columns())
    )


def feed_gaps(ticks: DataFrame, threshold_seconds: int = 120) -> DataFrame:
    """T-9: silences longer than the threshold, per symbol.

    Two ticks of one slot of threshold length are never too far apart, so only
    the first and last tick of each slot matter. Slots are compared inside their
    day and days with each other; no window ever holds raw ticks.
    """
    threshold_ms = threshold_seconds * 1000
    day_ms = 86_400_000
    slots = (
        ticks.groupBy(
            "symbol", F.floor(F.col("trade_time") / threshold_ms).cast("bigint").alias("slot")
        )
        .agg(F.min("trade_time").alias("first_ms"), F.max("trade_time").alias("last_ms"))
        .withColumn("day", F.floor(F.col("first_ms") / day_ms).cast("bigint"))
    )
    in_day = Window.partitionBy("symbol", "day").orderBy("slot")
    inside = slots.select(
        "symbol",
        F.col("last_ms").alias("gap_start_ms"),
        F.lead("first_ms").over(in_day).alias("gap_end_ms"),
    )
    days = slots.groupBy("symbol", "day").agg(
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")
    )
    between = days.select(
        "symbol",
        F.col("last_ms").alias("gap_start_ms"),
        F.lead("first_ms").over(symbol_window("day")).alias("gap_end_ms"),
    )
    length = F.col("gap_end_ms") - F.col("gap_start_ms")
    return (
        inside.unionByName(between)
        .filter(length > threshold_ms)
        .select(
            "symbol",
            F.timestamp_millis("gap_start_ms").alias("gap_start"),
            F.timestamp_millis("gap_end_ms").alias("gap_end"),
            (length / 1000.0).alias("gap_seconds"),
        )
    )


# --- over bars ----------------------------------------------------------------
# Windows below hold the bars of one symbol: one row per calendar day at most.


def _last_rows(n: int, order: str = "fetch_date") -> Window:
    return symbol_window(order).rowsBetween(-(n - 1), 0)


def _full_frame(value: Column, n: int, counted: Column) -> Column:
    """``value`` only where the trailing frame already holds n values."""
    return F.when(F.count(counted).over(_last_rows(n)) == n, value)


def moving_average(column: str, n: int) -> Column:
    """W-6: simple moving average, null until n rows exist."""
    return _full_frame(F.avg(column).over(_last_rows(n)), n, F.col(column))


# Up to this length averages add up columns of past closes; a longer frame slides.
MAX_LAGS = 32


def _closes(n: int) -> list[Column]:
    """The last n closes, oldest first; the columns of ``with_past_closes``."""
    return [F.col("close_price" if k == 0 else f"_close_{k}") for k in reversed(range(n))]


def with_past_closes(bars: DataFrame, n: int) -> DataFrame:
    """The n closes before each bar, those that are not there yet.

    A lag costs a row once, where a sliding frame adds up all its bars again for each row.
    """
    missing = [k for k in range(1, n + 1) if f"_close_{k}" not in bars.columns]
    return bars.withColumns({f"_close_{k}": F.lag("close_price", k).over(symbol_window()) for k in missing})


def without_past_closes(bars: DataFrame, but: DataFrame | None = None) -> DataFrame:
    """Without those columns, but for the ones that ``but`` has."""
    kept = but.columns if but is not None else []
    return bars.drop(*[c for c in bars.columns if c.startswith("_close_") and c not in kept])


def _mean(values: list[Column]) -> Column:
    """Added up in order; null if one is."""
    return reduce(lambda a, b: a + b, values) / len(values)


def with_moving_averages(bars: DataFrame, lengths: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """W-6"""
    if max(lengths, default=0) > MAX_LAGS:
        return bars.withColumns({f"sma_{n}": moving_average("close_price", n) for n in lengths})
    past = with_past_closes(bars, max(lengths, default=0) - 1)
    return without_past_closes(past.withColumns({f"sma_{n}": _mean(_closes(n)) for n in lengths}), bars)


def with_lags(bars: DataFrame, columns: dict[str, str], offsets: tuple[int, ...]) -> DataFrame:
    """W-7: ``columns`` maps a source column to the prefix of its lag columns."""
    return bars.withColumns(
        {
            f"{prefix}_lag_{k}": F.lag(source, k).over(symbol_window())
            for source, prefix in columns.items()
            for k in offsets
        }
    )


def with_step_returns(bars: DataFrame, steps: tuple[int, ...] = (1, 4, 24)) -> DataFrame:
    """W-10: return over k bars, as a fraction."""
    close = F.col("close_price")
    return bars.withColumns(
        {
            f"return_{k}": F.try_divide(close, F.lag(close, k).over(symbol_window())) - 1
            for k in steps
        }
    )


def with_volatility(bars: DataFrame, n: int = 20) -> DataFrame:
    """W-10: sample deviation of the last n one-bar returns (needs ``return_1``)."""
    deviation = F.stddev_samp("return_1").over(_last_rows(n))
    return bars.withColumn(f"volatility_{n}", _full_frame(deviation, n, F.col("return_1")))


def with_price_ratios(bars: DataFrame, length: int = 20, vwap: str | None = None) -> DataFrame:
    """W-10: close against its moving average (W-6, if it is there already) and, given one, a VWAP column."""
    known = f"sma_{length}"
    mean = F.col(known) if known in bars.columns else moving_average("close_price", length)
    bars = bars.withColumn(f"price_sma_{length}_ratio", F.try_divide(F.col("close_price"), mean))
    if vwap is not None:
        bars = bars.withColumn("price_vwap_ratio", F.try_divide("close_price", vwap))
    return bars


def daily_vwap(ticks: DataFrame, day: Column) -> DataFrame:
    """A-5 per symbol and day."""
    return (
        ticks.groupBy("symbol", day.alias("fetch_date"))
        .agg(
            F.sum(F.col("price") * F.col("quantity")).alias("pq"),
            F.sum("quantity").alias("q"),
            F.avg("price").alias("mean"),
        )
        .select(
            "symbol", "fetch_date", vwap_of(F.col("pq"), F.col("q"), F.col("mean")).alias("vwap")
        )
    )


def _with_lagged_moves(bars: DataFrame, n: int) -> DataFrame:
    """Number of the last n moves, and if there are n, their mean gain and loss, from past closes."""
    past = with_past_closes(bars, n)
    closes = _closes(n + 1)
    pairs = zip(closes, closes[1:], strict=False)
    past = past.withColumns({f"_move_{i}": later - before for i, (before, later) in enumerate(pairs)})
    moves = [F.col(f"_move_{i}") for i in range(n)]
    zero = F.lit(0.0)
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in closes])
    found = past.withColumns(
        {
            "_moves": F.when(known, n),
            "_gains": _mean([F.greatest(m, zero) for m in moves]),
            "_losses": _mean([F.greatest(-m, zero) for m in moves]),
        }
    )
    return without_past_closes(found.drop(*[f"_move_{i}" for i in range(n)]), bars)


def _with_sliding_moves(bars: DataFrame, n: int) -> DataFrame:
    """The same over a sliding frame."""
    move = F.col("close_price") - F.lag("close_price", 1).over(symbol_window())
    moves = bars.withColumn("_move", move).withColumns(
        {
            "_gain": F.greatest(F.col("_move"), F.lit(0.0)),
            "_loss": F.greatest(-F.col("_move"), F.lit(0.0)),
        }
    )
    # greatest() skips nulls, so the first row must be excluded explicitly.
    frame = _last_rows(n)
    return moves.withColumns(
        {
            "_moves": F.count("_move").over(frame),
            "_gains": F.avg(F.when(F.col("_move").isNotNull(), F.col("_gain"))).over(frame),
            "_losses": F.avg(F.when(F.col("_move").isNotNull(), F.col("_loss"))).over(frame),
        }
    ).drop("_move", "_gain", "_loss")


def with_rsi(bars: DataFrame, n: int = 14, high: float = 70.0, low: float = 30.0) -> DataFrame:
    """W-11: RSI from plain averages of the last n moves, and its signal.

    Without losses it is 100, without any move 50. The signal is -1 at or above
    ``high``, 1 at or below ``low``, else 0.
    """
    moves = _with_lagged_moves(bars, n) if n < MAX_LAGS else _with_sliding_moves(bars, n)
    rsi = (
        F.when((F.col("_gains") == 0) & (F.col("_losses") == 0), 50.0)
        .when(F.col("_losses") == 0, 100.0)
        .otherwise(100 - F.try_divide(F.lit(100.0), 1 + F.try_divide("_gains", "_losses")))
    )
    with_value = moves.withColumn(f"rsi_{n}", F.when(F.col("_moves") == n, rsi))
    value = F.col(f"rsi_{n}")
    signal = F.when(value >= high, -1).when(value <= low, 1).when(value.isNotNull(), 0)
    return with_value.withColumn("rsi_signal", signal).drop(
        "_moves", "_gains", "_losses"
    )


# How far a weight may grow inside one block of bars, as a power of ten; doubles reach 1e308.
EMA_DIGITS = 200
# What older blocks may weigh at most, as a negative power of ten, for averages that share their blocks.
EMA_SHARED_DIGITS = 40


def _ema_decay(n: int) -> float:
    return 1 - 2.0 / (n + 1)


def _ema_block(n: int) -> int:
    """Bars in a block: as many as a double allows."""
    return max(1, int(EMA_DIGITS / -math.log10(_ema_decay(n))))


def with_ema(bars: DataFrame, n: int, column: str = "close_price") -> DataFrame:
    """W-12: exponential moving average, weight 2/(n+1), seeded with the first bar; see ``with_emas``."""
    return with_emas(bars, (n,), column)


def with_emas(bars: DataFrame, lengths: tuple[int, ...], column: str = "close_price") -> DataFrame:
    """W-12 for several lengths.

    A prefix scan on two levels, linear in the bars. Inside a block the average is a running sum of bars with
    growing weights, scaled back at each bar. The blocks are as long as a double allows
    (thousands of bars; a year has 366), so of the blocks before only the last one's closing average
    still weighs anything: older bars count for less than 1e-200 of a price, or 1e-40 where lengths share
    the shortest of their blocks. A null price leaves the average null from there on.

    Bars are sorted twice, to number them and by block; lengths that can share blocks share both sorts.
    """
    ordered = symbol_window()
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    complete = F.count(F.when(F.col(column).isNull(), 1)).over(so_far) == 0
    long = [n for n in lengths if _ema_decay(n) > 0]
    block = min((_ema_block(n) for n in long), default=1)
    if any(min(EMA_SHARED_DIGITS, -_ema_block(n) * math.log10(_ema_decay(n))) > -block * math.log10(_ema_decay(n)) for n in long):
        for n in lengths:
            bars = with_emas(bars, (n,), column)
        return bars
    numbered = bars.withColumns({"_row": F.row_number().over(ordered) - 1, "_complete": complete})
    numbered = numbered.withColumns({"_block": F.floor(F.col("_row") / block), "_offset": F.col("_row") % block})
    in_block = (
        Window.partitionBy("symbol", "_block")
        .orderBy("fetch_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # The same order as by date alone, and the one that the rows are already in.
    earlier = (
        Window.partitionBy("symbol")
        .orderBy("_block", "fetch_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = {}
    for n in long:
        # The first bar enters with full weight.
        value = F.when(F.col("_row") == 0, F.col(column)).otherwise(F.col(column) * (2.0 / (n + 1)))
        # Both by powers of the same number, whose rounding then cancels out.
        weight = F.pow(F.lit(_ema_decay(n)), F.col("_offset"))
        local[f"_local_{n}"] = F.sum(value / weight).over(in_block) * weight
    scanned = numbered.withColumns(local) if local else numbered
    found = {}
    for n in lengths:
        if n not in long:
            found[f"ema_{n}"] = F.when(F.col("_complete"), F.col(column))
            continue
        closing = F.when(F.col("_offset") == block - 1, F.col(f"_local_{n}"))
        before = F.last(closing, ignorenulls=True).over(earlier)
        carried = F.coalesce(before, F.lit(0.0)) * F.pow(F.lit(_ema_decay(n)), F.col("_offset") + 1)
        found[f"ema_{n}"] = F.when(F.col("_complete"), F.col(f"_local_{n}") + carried)
    return scanned.withColumns(found).drop("_row", "_complete", "_block", "_offset", *local)


def with_volume_anomaly(
    bars: DataFrame, n: int = 20, limit: float = 3.0, volume: str = "volume"
) -> DataFrame:
    """W-15: z-score of log volume against the n bars before, and its flag."""
    logged = bars.withColumn("_log", F.log1p(F.col(volume).cast("double")))
    past = symbol_window().rowsBetween(-n, -1)
    scored = logged.withColumns(
        {
            "_count": F.count("_log").over(past),
            "_mean": F.avg("_log").over(past),
            "_deviation": F.stddev_samp("_log").over(past),
        }
    )
    score = F.when(
        (F.col("_count") == n) & (F.col("_deviation") > 0),
        (F.col("_log") - F.col("_mean")) / F.col("_deviation"),
    )
    return (
        scored.withColumn("volume_z", score)
        .withColumn("is_abnormal", F.coalesce(F.abs("volume_z") > limit, F.lit(False)))
        .drop("_log", "_count", "_mean", "_deviation")
    )


def with_ranks(bars: DataFrame, column: str) -> DataFrame:
    """W-9: position of each bar among those of its symbol, highest ``column`` first.

    Ties are broken by date for ``row_number``.
    """
    by_value = Window.partitionBy("symbol").orderBy(F.desc(column))
    unique = Window.partitionBy("symbol").orderBy(F.desc(column), "fetch_date")
    return bars.withColumns(
        {
            "row_number": F.row_number().over(unique),
            "rank": F.rank().over(by_value),
            "dense_rank": F.dense_rank().over(by_value),
        }
    )
