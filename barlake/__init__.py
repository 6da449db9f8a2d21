"""Market-data lakehouse on Spark: ticks -> bronze -> daily bars -> serving."""

__version__ = "0.1.0"
