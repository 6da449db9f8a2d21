"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.storage import remove_tree, scratch_path


class Scratch:
    """Tables written to the shared folder and read back.

    This cuts lineage without relying on executors staying alive. ``table`` keeps the table
    until ``clear``; a result's own table is written with ``result`` and stays.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def result(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.last = path
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        table = self.result(df, name)
        self.paths.append(self.last)
        return table

    def clear(self) -> None:
        for path in self.paths:
            remove_tree(self.spark, path)
        self.paths = []
