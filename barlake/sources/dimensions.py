"""Dimension sources (S-5, S-6, S-7, S-12, K-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions.scalars import date_key

# The calendar range of the date dimension.
FIRST_YEAR = 2000
LAST_YEAR = 2050


def calendar_columns(days: DataFrame, day: str = "day_date") -> DataFrame:
    """The date-dimension columns of a frame of dates."""
    date = F.col(day)
    return days.select(
        date_key(date).alias("date_key"),
        F.date_format(date, "yyyy-MM-dd").alias("full_date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        (F.weekday(date) + 1).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.date_format(date, "MMMM").alias("month_name"),
        (F.weekday(date) >= 5).cast("int").alias("is_weekend"),
    )


def generate_dim_date(
    spark: SparkSession, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> DataFrame:
    """S-12: one row per day; 366 rows per year at most, so safe to broadcast."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                F.make_date(F.lit(last_year), F.lit(12), F.lit(31)),
                F.expr("interval 1 day"),
            )
        ).alias("day_date")
    )
    return calendar_columns(days)


def export_csv(df: DataFrame, path: str) -> None:
    """K-10: CSV with header. Meant for dimensions; written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_dim_date_csv(spark: SparkSession, path: str) -> DataFrame:
    """S-5: the date dimension from CSV, with the declared types."""
    return spark.read.schema(schemas.DIM_DATE_DDL).option("header", True).csv(path)


def read_symbols(spark: SparkSession, path: str, currency: str = "USD") -> DataFrame:
    """S-6: the symbols config as ``dim_assets`` rows."""
    config = spark.read.schema(schemas.SYMBOLS_CONFIG_DDL).option("multiLine", True).json(path)
    return config.select(F.explode("symbols").alias("item")).select(
        "item.symbol",
        "item.name",
        F.col("item.type").alias("asset_type"),
        F.lit(currency).alias("currency"),
    )


def symbols_of_type(assets: DataFrame, asset_type: str) -> DataFrame:
    """S-7"""
    return assets.filter(F.col("asset_type") == asset_type).select("symbol")
