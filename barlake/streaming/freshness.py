"""Stale feeds on a stream (T-9).

Ticks are summed up per symbol and slot first, with a map-side combine, so a busy symbol costs the second
step a row for each slot. That step keeps one row of state per symbol, its newest event, and a
timer that runs out when the symbol has been silent for too long by the clock of the stream, its watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

ALERT_DDL = "symbol STRING, last_event TIMESTAMP, silent_after TIMESTAMP"


def last_seen(ticks: DataFrame) -> DataFrame:
    """Newest event per symbol. State is one row per symbol."""
    return ticks.groupBy("symbol").agg(F.max("event_time").alias("last_event"))


def stale_symbols(seen: DataFrame, now: Column, threshold_seconds: int = 120) -> DataFrame:
    """Symbols without a record for longer than the threshold at ``now``."""
    silence = F.unix_seconds(now) - F.unix_seconds("last_event")
    return seen.withColumn("silent_seconds", silence).filter(
        F.col("silent_seconds") > threshold_seconds
    )


class Silences(StatefulProcessor):
    """Turns the slots of a symbol into one alert for each of its silences.

    Silences between events are found when the later event arrives, open ones by a timer. The timer waits a
    slot longer than the threshold: by then every event that could end the silence in time
    has come out of its slot. A silence reported by the timer is not reported again.
    """

    def __init__(self, threshold_ms: int):
        self.threshold_ms = threshold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("newest", "last_ms BIGINT, alerted BOOLEAN")

    def _alert(self, symbol: str, last_ms: int) -> Row:
        return Row(symbol=symbol, last_ms=last_ms, silent_ms=last_ms + self.threshold_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (symbol,) = key
        # One row for each slot that closed in this batch.
        slots = sorted((r.first_ms, r.last_ms) for r in rows)
        known = self.state.get()
        last, alerted = (known[0], known[1]) if known is not None else (None, False)
        if last is not None:
            self.handle.deleteTimer(last + 2 * self.threshold_ms)
        for first, newest in slots:
            if last is not None and first - last > self.threshold_ms and not alerted:
                yield self._alert(symbol, last)
            last, alerted = newest, False
        self.state.update((last, alerted))
        self.handle.registerTimer(last + 2 * self.threshold_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, alerted = self.state.get()
        if not alerted:
            self.state.update((last, True))
            yield self._alert(key[0], last)

    def close(self) -> None:
        pass


def silence_alerts(
    ticks: DataFrame, threshold_seconds: int = 120, watermark: str = "1 minute"
) -> DataFrame:
    """T-9: every silence longer than the threshold, once (append mode).

    Events later than the watermark are dropped. ``ticks`` needs ``symbol`` and ``event_time``.
    """
    slots = (
        ticks.withWatermark("event_time", watermark)
        .groupBy("symbol", F.window("event_time", f"{threshold_seconds} seconds").alias("slot"))
        .agg(F.min("event_time").alias("first"), F.max("event_time").alias("last"))
        .select(
            "symbol",
            F.window_time("slot").alias("slot_time"),
            F.unix_millis("first").alias("first_ms"),
            F.unix_millis("last").alias("last_ms"),
        )
    )
    found = slots.groupBy("symbol").transformWithState(
        statefulProcessor=Silences(threshold_seconds * 1000),
        outputStructType="symbol STRING, last_ms BIGINT, silent_ms BIGINT",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(
        "symbol",
        F.timestamp_millis("last_ms").alias("last_event"),
        F.timestamp_millis("silent_ms").alias("silent_after"),
    )


def write_alerts(
    alerts: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds"
) -> StreamingQuery:
    """Append alerts to a table; the sink's commit log keeps a repeated batch from adding any twice."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        alerts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_freshness_watch(
    ticks: DataFrame,
    alert: Callable[[DataFrame], None],
    checkpoint: str,
    threshold_seconds: int = 120,
    interval: str | None = "10 seconds",
    now: Column | None = None,
) -> StreamingQuery:
    """T-9 by the wall clock: every trigger, hand the symbols that are silent to ``alert``.

    Complete mode shows all symbols each time, also those the batch says nothing
    about, which are the ones that matter. For few symbols; ``silence_alerts`` reports
    each silence once and writes only what is new.
    """
    clock = F.current_timestamp() if now is None else now

    def check(batch: DataFrame, batch_id: int) -> None:
        alert(stale_symbols(batch, clock, threshold_seconds))

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        last_seen(ticks)
        .writeStream.outputMode("complete")
        .foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
