"""Star-schema joins (J-2..J-4, J-6).

Assets are joined without a hint: Spark broadcasts the table when its own size
statistics allow it, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.accounting import REASON, mark_missing
from barlake.operators.bars import PRICES


def gold_daily_prices(fact: DataFrame, dim_date: DataFrame, dim_assets: DataFrame) -> DataFrame:
    """J-2, J-3: the flat serving table."""
    days = dim_date.select("date_key", F.to_date("full_date").alias("fetch_date"))
    assets = dim_assets.select("symbol", "currency", "asset_type")
    return (
        fact.join(F.broadcast(days), "date_key", "inner")
        .join(assets, "symbol", "inner")
        .select("symbol", "fetch_date", *PRICES, "volume", "currency", "asset_type")
    )


def marked_gold(fact: DataFrame, dim_date: DataFrame, dim_assets: DataFrame) -> DataFrame:
    """J-2, J-3 that keep all bars: those a join would drop carry the reason (P-10, P-11)."""
    days = dim_date.select("date_key", F.to_date("full_date").alias("fetch_date"))
    dated = mark_missing(fact, F.broadcast(days), "date_key", "no_date")
    assets = dim_assets.select("symbol", "currency", "asset_type")
    return mark_missing(dated, assets, "symbol", "no_asset").select(
        "symbol", "fetch_date", *PRICES, "volume", "currency", "asset_type", "batch_id", REASON
    )


def rows_without_match(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """J-4: rows an inner join on ``key`` would drop."""
    return rows.join(dimension.select(key), key, "left_anti")


def bars_without_date(bars: DataFrame, dim_date: DataFrame) -> DataFrame:
    """J-4 for the date dimension."""
    days = dim_date.select(F.to_date("full_date").alias("fetch_date"))
    return bars.join(F.broadcast(days), "fetch_date", "left_anti")


def federated_join(lake: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """J-6: lake rows with the columns of a table read over JDBC.

    An ordinary join. Only what Spark's JDBC source pushes down (columns and filters) runs
    on the other side.
    """
    return lake.join(remote, key, "inner")
