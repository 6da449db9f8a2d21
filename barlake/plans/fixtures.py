"""Ticks, payloads and dimensions read from the driver's tables.

Everything here is a projection of a given table, so it grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.ordering import TickOrder, pack_order_key

CRYPTO_TYPES = ("click", "view")
UNLISTED_TYPE = "signup"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_columns(events: DataFrame) -> DataFrame:
    """Ticks of an ``events`` frame, batch or streaming."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("trade_time"),
        F.col("event_id").alias("seq"),
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as symbols: few symbols, so every symbol is a hot one."""
    return event_columns(table(spark, sf_dir, "events"))


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as symbols: many symbols."""
    events = table(spark, sf_dir, "events")
    return event_columns(events.withColumn("event_type", F.concat(F.lit("U"), F.col("user_id"))))


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as symbols; all ticks of a day share their time."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("trade_time"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
    )


def lineitem_order() -> TickOrder:
    """Order of the tied ticks: rows equal in all parts have equal prices."""
    return TickOrder(
        pack_order_key(
            (F.col("l_orderkey"), 12),
            (F.col("l_linenumber"), 2),
            (F.round(F.col("l_extendedprice") * 100), 11),
            (F.col("l_quantity"), 3),
        )
    )


def event_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One asset per event type but one, which the inner joins then drop."""
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    return kinds.filter(F.col("symbol") != UNLISTED_TYPE).select(
        "symbol",
        F.initcap("symbol").alias("name"),
        F.when(F.col("symbol").isin(*CRYPTO_TYPES), "crypto").otherwise("stock").alias(
            "asset_type"
        ),
        F.lit("USD").alias("currency"),
    )


def messages_of(ticks: DataFrame, value: Column) -> DataFrame:
    """Envelopes around a message body, numbered by ``seq``."""
    return ticks.select(
        F.col("symbol").alias("key"),
        value.alias("value"),
        F.when(F.col("symbol").isin(*CRYPTO_TYPES), "crypto_trades")
        .otherwise("stock_trades")
        .alias("topic"),
        (F.col("seq") % 3).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_millis("trade_time").alias("timestamp"),
    )


def tick_json() -> Column:
    return F.to_json(F.struct("symbol", "price", "quantity", "trade_time"))


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(event_ticks(spark, sf_dir), tick_json())


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ticks of their customers; some are older than the date dimension."""
    ticks = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("symbol"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("trade_time"),
        F.col("o_orderkey").alias("seq"),
    )
    return messages_of(ticks, tick_json())


def customer_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third customer has no asset."""
    return table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 != 0).select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("symbol"),
        F.col("c_name").alias("name"),
        F.lit("stock").alias("asset_type"),
        F.lit("USD").alias("currency"),
    )


def corrupted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, some of them broken by a rule on the event id."""
    seq = F.col("seq")
    rest = F.struct("quantity", "trade_time")
    broken = (
        F.when(seq % 97 == 0, F.expr("left(body, length(body) - 9)"))
        .when(seq % 89 == 0, F.to_json(F.struct("price", "quantity", "trade_time")))
        .when(
            seq % 83 == 0,
            F.to_json(
                F.struct("symbol", F.lit("x").alias("price"), rest["quantity"].alias("quantity"))
            ),
        )
        .when(
            seq % 79 == 0,
            F.to_json(
                F.struct("symbol", "price", (-1 - F.col("quantity")).alias("quantity"), "trade_time")
            ),
        )
        .otherwise(F.col("body"))
    )
    ticks = event_ticks(spark, sf_dir).withColumn("body", tick_json())
    return messages_of(ticks, broken)


def crypto_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade payloads, wrapped for even and bare for odd ids."""
    trade = F.to_json(
        F.struct(
            F.concat(F.upper("symbol"), F.lit("USDT")).alias("s"),
            F.col("price").cast("string").alias("p"),
            F.col("quantity").cast("string").alias("q"),
            F.col("trade_time").alias("T"),
        )
    )
    wrapped = F.concat(F.lit('{"stream":"trade","data":'), trade, F.lit("}"))
    return messages_of(
        event_ticks(spark, sf_dir), F.when(F.col("seq") % 2 == 0, wrapped).otherwise(trade)
    )


def stock_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote payloads; every 10th has no price, every 7th no time, every 11th no result."""
    meta = F.to_json(
        F.struct(
            F.when(F.col("seq") % 10 != 0, F.col("price")).alias("regularMarketPrice"),
            F.when(F.col("seq") % 7 != 0, F.floor(F.col("trade_time") / 1000)).alias(
                "regularMarketTime"
            ),
        )
    )
    chart = F.concat(F.lit('{"chart":{"result":[{"meta":'), meta, F.lit("}]}}"))
    empty = F.lit('{"chart":{"result":[]}}')
    return messages_of(
        event_ticks(spark, sf_dir), F.when(F.col("seq") % 11 == 0, empty).otherwise(chart)
    )


def daily_payload_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy daily payloads; every 11th has an empty chart."""
    metadata = F.to_json(
        F.struct(
            "symbol",
            F.initcap("symbol").alias("name"),
            F.lit("stock").alias("asset_type"),
            F.date_format(F.timestamp_millis("trade_time"), "yyyy-MM-dd'T'HH:mm:ss").alias(
                "fetch_timestamp"
            ),
        )
    )
    chart = F.to_json(
        F.struct(
            F.struct(
                F.col("price").alias("regularMarketPrice"),
                F.floor(F.col("trade_time") / 1000).alias("regularMarketTime"),
            ).alias("meta")
        )
    )
    raw = F.when(F.col("seq") % 11 == 0, "{}").otherwise(chart)
    return messages_of(
        event_ticks(spark, sf_dir),
        F.concat(F.lit('{"metadata":'), metadata, F.lit(',"raw_data":'), raw, F.lit("}")),
    )
