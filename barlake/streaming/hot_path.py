"""Sliding-window indicators over a stream (T-3..T-7, K-8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from barlake import schemas
from barlake.functions.scalars import event_time
from barlake.operators.indicators import pane_aggregates, window_aggregates
from barlake.operators.quality import classify, valid_ticks
from barlake.operators.upsert import merge_upsert
from barlake.sources.jdbc import JdbcTarget, upsert_jdbc

INDICATOR_KEYS = ["symbol", "window_start"]


def tick_stream(messages: DataFrame) -> DataFrame:
    """Valid ticks of a message stream, with their event time."""
    return valid_ticks(classify(messages), keep=()).withColumn("event_time", event_time())


def hot_indicators(
    ticks: DataFrame,
    watermark: str = "1 minute",
    width: str = "1 minute",
    slide: str = "10 seconds",
) -> DataFrame:
    """T-3, T-4: windowed SMA, VWAP and count; late ticks fall to the watermark.

    Spark combines each micro-batch per (symbol, window) before the shuffle, so
    the state store gets one row per task and window, however hot the symbol.
    """
    return window_aggregates(ticks.withWatermark("event_time", watermark), width, slide)


def settled_indicators(
    ticks: DataFrame,
    watermark: str = "1 minute",
    width: str = "1 minute",
    slide: str = "10 seconds",
) -> DataFrame:
    """T-3, T-4 in append mode: each window once, when the watermark has passed it.

    Two stateful aggregates in a row: ticks are summed into panes, panes into windows. No tick is copied
    into the windows it lies in, and no upsert is needed behind it; the price is
    that a window shows up only when it is complete.
    """
    return pane_aggregates(ticks.withWatermark("event_time", watermark), width, slide)


def start_settled_path(
    indicators: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds", grain: str = "hour"
) -> StreamingQuery:
    """Append settled windows to a Parquet table partitioned by time, each exactly once.

    Hours suit a live stream; days a table filled from history.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    part = F.date_format("window_start", GRAINS[grain]).cast("int")
    return (
        indicators.withColumn("window_part", part)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("window_part")
        .trigger(**trigger)
        .start()
    )


def upsert_batches(write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """K-8: a ``foreachBatch`` function around an upsert by key.

    Writing a batch twice leaves the same rows, so a replayed batch is harmless.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write(batch)

    return write_batch


# Partition column of the indicator table -> its date pattern.
GRAINS = {"hour": "yyyyMMddHH", "day": "yyyyMMdd"}


def parquet_writer(path: str, grain: str = "hour") -> Callable[[DataFrame], None]:
    """Upsert of indicator rows into a Parquet table partitioned by time.

    A live stream touches the current partition or two and rewrites just those,
    so they should be short; days suit a table filled from history.
    """
    part = F.date_format("window_start", GRAINS[grain]).cast("int")

    def write(batch: DataFrame) -> None:
        merge_upsert(
            batch.sparkSession,
            path,
            batch.withColumn("window_part", part),
            INDICATOR_KEYS,
            ["window_part"],
            f"{schemas.INDICATORS_DDL}, window_part INT",
        )

    return write


def jdbc_writer(target: JdbcTarget, table: str) -> Callable[[DataFrame], None]:
    """Upsert of indicator rows into the serving database."""

    def write(batch: DataFrame) -> None:
        upsert_jdbc(batch, target, table, INDICATOR_KEYS)

    return write


def start_hot_path(
    indicators: DataFrame,
    write: Callable[[DataFrame], None],
    checkpoint: str,
    interval: str | None = "10 seconds",
) -> StreamingQuery:
    """T-6, T-7: update mode into an upsert. ``interval=None`` drains and stops."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        indicators.writeStream.outputMode("update")
        .foreachBatch(upsert_batches(write))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


class LateRows(StreamingQueryListener):
    """T-5: aggregate inputs that arrived too late, by query id, over the whole run.

    Add it to ``spark.streams`` before the query starts. A late tick counts once per
    window it would have entered.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
