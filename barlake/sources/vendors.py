"""Vendor payloads to ticks (S-9..S-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions.parsing import with_parsed


def crypto_aliases(assets: DataFrame) -> DataFrame:
    """Exchange symbol -> our symbol for the configured crypto assets."""
    return assets.filter(F.col("asset_type") == "crypto").select(
        F.replace(F.col("symbol"), F.lit("-USD"), F.lit("USDT")).alias("raw_symbol"), "symbol"
    )


def stream_names(assets: DataFrame) -> DataFrame:
    """Trade-channel names of the configured crypto assets."""
    return crypto_aliases(assets).select(
        F.concat(F.lower("raw_symbol"), F.lit("@trade")).alias("stream")
    )


def crypto_ticks(payloads: DataFrame, aliases: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S-9: trade payloads, wrapped or bare; unknown symbols fall out.

    Text that is no number gives a null, which the dead-letter split reports.
    """
    body = F.from_json("value", schemas.CRYPTO_PAYLOAD_DDL)
    trade = F.coalesce(
        F.col("body.data"), F.struct("body.s", "body.p", "body.q", F.col("body.T").alias("T"))
    )
    trades = with_parsed(payloads, "body", body).select(trade.alias("trade"), *keep)
    return trades.join(
        aliases, F.col("trade.s") == F.col("raw_symbol"), "inner"
    ).select(
        "symbol",
        F.col("trade.p").try_cast("double").alias("price"),
        F.col("trade.q").try_cast("double").alias("quantity"),
        F.col("trade.T").alias("trade_time"),
        *keep,
    )


def stock_ticks(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S-10: first chart result; the key is the symbol, each poll counts 1.0.

    A payload without a quote time takes the envelope timestamp; one without a
    price is dropped.
    """
    chart = F.from_json("value", schemas.STOCK_PAYLOAD_DDL)
    quote = F.get(F.col("body.chart.result"), F.lit(0)).getField("meta")
    quotes = with_parsed(payloads, "body", chart).withColumn("quote", quote)
    seconds = F.coalesce(F.col("quote.regularMarketTime"), F.unix_seconds("timestamp"))
    return quotes.filter(F.col("quote.regularMarketPrice").isNotNull()).select(
        F.col("key").alias("symbol"),
        F.col("quote.regularMarketPrice").alias("price"),
        F.lit(1.0).alias("quantity"),
        (seconds * 1000).alias("trade_time"),
        *keep,
    )


def daily_payloads(payloads: DataFrame) -> DataFrame:
    """S-11: metadata columns and the raw chart as VARIANT; empty charts fall out."""
    body = F.from_json("value", schemas.DAILY_PAYLOAD_DDL)
    chart = F.try_parse_json("body.raw_data")
    return (
        with_parsed(with_parsed(payloads, "body", body), "raw_data", chart)
        .select(
            "body.metadata.symbol",
            "body.metadata.name",
            "body.metadata.asset_type",
            F.try_to_timestamp(F.col("body.metadata.fetch_timestamp")).alias("fetch_timestamp"),
            "raw_data",
        )
        .filter(
            F.col("raw_data").isNotNull()
            & ~F.coalesce(F.is_variant_null("raw_data"), F.lit(False))
            & (F.to_json("raw_data") != "{}")
        )
    )


def daily_quote(daily: DataFrame) -> DataFrame:
    """Price and quote time out of the VARIANT chart."""
    price = F.try_variant_get("raw_data", "$.meta.regularMarketPrice", "double")
    seconds = F.try_variant_get("raw_data", "$.meta.regularMarketTime", "bigint")
    return daily.select(
        "symbol",
        "name",
        "asset_type",
        "fetch_timestamp",
        price.alias("price"),
        (seconds * 1000).alias("trade_time"),
    )
