"""Messages to bronze (K-1, T-1, T-2, T-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

MESSAGE_ID = ["topic", "partition", "offset"]


def write_bronze(
    messages: DataFrame, path: str, checkpoint: str, by_ingest_date: bool = False
) -> StreamingQuery:
    """K-1, T-1, T-2: append what is there as JSON, commit the offsets, stop.

    A restart continues from the checkpoint; the sink's commit log hides the
    files of unfinished batches.
    """
    partitions = []
    if by_ingest_date:
        messages = messages.withColumn("ingest_date", F.to_date("timestamp"))
        partitions = ["ingest_date"]
    return (
        messages.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .trigger(availableNow=True)
        .start()
    )


def drop_redelivered(
    messages: DataFrame, delay: str = "10 minutes", keys: list[str] | None = None
) -> DataFrame:
    """T-8: drop messages seen before, within the watermark."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        keys or MESSAGE_ID
    )
