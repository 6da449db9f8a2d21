"""Parse a message once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parsed(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """``df`` with an expensive column that later steps cannot duplicate.

    Catalyst pushes filters below a projection by copying its expressions, and a
    copied ``from_json`` parses every message again, for each place it is used.
    Filters are not copied below a generator, so the value is produced by one.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))
