"""Schemas M1-M12 as DDL strings. Nothing in the package infers a schema."""

from __future__ import annotations

TICK_DDL = "symbol STRING, price DOUBLE, quantity DOUBLE, trade_time BIGINT"

# M2; `topic` is kept because offsets are unique only inside a topic partition.
ENVELOPE_DDL = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# M3: the combined-stream wrapper and the bare trade share one declaration.
_TRADE_DDL = "s: STRING, p: STRING, q: STRING, T: BIGINT"
CRYPTO_PAYLOAD_DDL = (
    f"stream STRING, data STRUCT<{_TRADE_DDL}>, s STRING, p STRING, q STRING, T BIGINT"
)

# M4
_CHART = (
    "STRUCT<result: ARRAY<STRUCT<meta: STRUCT<"
    "regularMarketPrice: DOUBLE, regularMarketTime: BIGINT>>>>"
)
STOCK_PAYLOAD_DDL = f"chart {_CHART}"

# M5; `raw_data` stays text here and becomes VARIANT in the parser.
DAILY_PAYLOAD_DDL = (
    "metadata STRUCT<symbol: STRING, name: STRING, asset_type: STRING, fetch_timestamp: STRING>,"
    " raw_data STRING"
)

# M6
SYMBOLS_CONFIG_DDL = "symbols ARRAY<STRUCT<symbol: STRING, name: STRING, type: STRING>>"

DIM_ASSETS_DDL = "symbol STRING, name STRING, asset_type STRING, currency STRING"

DIM_DATE_DDL = (
    "date_key INT, full_date STRING, year INT, quarter INT, month INT, day INT,"
    " day_of_week INT, day_name STRING, month_name STRING, is_weekend INT"
)

FACT_DDL = (
    "symbol STRING, date_key INT, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE,"
    " close_price DOUBLE, volume BIGINT, daily_return DOUBLE, price_range DOUBLE"
)

# The stored fact also keeps what later ticks of the same day merge with (the sums also make
# the VWAP), the last batch a bar took in, and the partition key.
FACT_TABLE_DDL = (
    f"{FACT_DDL}, volume_exact DOUBLE, open_key DECIMAL(38,0), close_key DECIMAL(38,0),"
    " tick_count BIGINT, price_quantity DOUBLE, price_sum DOUBLE, batch_id BIGINT, month_key INT"
)

GOLD_DDL = (
    "symbol STRING, fetch_date DATE, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE,"
    " close_price DOUBLE, volume BIGINT, currency STRING, asset_type STRING"
)

INDICATORS_DDL = (
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, sma DOUBLE, vwap DOUBLE,"
    " trade_count INT"
)

PREDICTIONS_DDL = (
    "symbol STRING, prediction_date DATE, predicted_direction INT, probability DOUBLE,"
    " model_version STRING, created_at TIMESTAMP"
)
