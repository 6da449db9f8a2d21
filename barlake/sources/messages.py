"""Message streams and the bronze table (S-1..S-4, F-1, K-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions.parsing import with_parsed
from barlake.storage import has_files


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """S-1, S-2, O-6: one stream over several topics.

    Needs the Kafka connector on the class path. ``starting_offsets="latest"``
    gives the hot-path scan.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    return envelope(reader.options(**options).load())


def file_stream(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """Envelopes from a folder of JSON files, in place of a broker."""
    reader = spark.readStream.schema(schemas.ENVELOPE_DDL)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return envelope(reader.json(path))


def envelope(messages: DataFrame) -> DataFrame:
    """S-3: key and value as text, plus topic, partition, offset and timestamp."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """S-4: batch scan of bronze; a missing or empty folder gives no rows.

    A folder written by the streaming sink is read through its commit log, so
    files of a failed batch stay invisible.
    """
    if not has_files(spark, path):
        return spark.createDataFrame([], schemas.ENVELOPE_DDL)
    return spark.read.schema(schemas.ENVELOPE_DDL).json(path)


def parse_ticks(messages: DataFrame, keep: tuple[str, ...] = ("topic", "partition", "offset")):
    """F-1, F-2: tick columns of every message that names a symbol."""
    return (
        with_parsed(messages, "tick", F.from_json("value", schemas.TICK_DDL))
        .select("tick.*", *keep)
        .filter(F.col("symbol").isNotNull())
    )


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """K-11: keyed messages, ready for ``publish``."""
    return ticks.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct("symbol", "price", "quantity", "trade_time")).alias("value"),
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """K-11: write keyed messages to a topic (needs the Kafka connector)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def sample_ticks(spark: SparkSession, start_ms: int, count: int = 10) -> DataFrame:
    """S-14: the smoke-test ticks, a price ladder on one symbol. Fixed values."""
    return spark.range(count).select(
        F.lit("BTCUSDT").alias("symbol"),
        (95000.0 + F.col("id") * 100).alias("price"),
        (0.5 + F.col("id") * 0.1).alias("quantity"),
        (F.lit(start_ms) + F.col("id") * 1000).alias("trade_time"),
    )
