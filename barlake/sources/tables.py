"""Lake tables: DDL, scans, appends and seeding (S-8, K-2..K-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.storage import has_files

# table -> (columns, partition columns)
STAR_TABLES = {
    "dim_assets": (schemas.DIM_ASSETS_DDL, ["asset_type"]),
    "dim_date": (schemas.DIM_DATE_DDL, ["year"]),
    "fact_daily_prices": (schemas.FACT_TABLE_DDL, ["month_key"]),
}


def create_star_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """K-3: namespace and partitioned tables, where they do not exist yet."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    for table, (ddl, partitions) in STAR_TABLES.items():
        place = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl}) USING parquet"
            f" PARTITIONED BY ({', '.join(partitions)}){place}"
        )


def recover_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Tell the catalog which partitions the folder has now, and forget what was cached of it.

    Jobs write folders; a table that was declared over one sees new partitions only after this.
    """
    name = f"{database}.{table}"
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def recover_star_schema(spark: SparkSession, database: str, location: str) -> None:
    """``recover_partitions`` for the tables whose folder exists."""
    for table in STAR_TABLES:
        if has_files(spark, f"{location.rstrip('/')}/{table}"):
            recover_partitions(spark, database, table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S-8: scan by catalog name."""
    return spark.read.table(name)


def read_parquet_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """S-8: scan by path; a table nobody wrote yet has no rows."""
    if not has_files(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """K-2"""
    gathered(df, partition_cols).write.mode("append").partitionBy(*(partition_cols or [])).parquet(
        path
    )


def gathered(df: DataFrame, partition_cols: list[str] | None) -> DataFrame:
    """Rows of a table partition brought together, for few files per partition.

    A rebalance, not a repartition: AQE spreads a large partition over tasks.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def append_table(df: DataFrame, name: str, partition_cols: list[str] | None = None) -> None:
    """K-2 through the catalog."""
    rows = gathered(df, partition_cols)
    rows.write.mode("append").format("parquet").partitionBy(*(partition_cols or [])).saveAsTable(name)


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """K-12: rerunning a batch replaces exactly the partitions it wrote."""
    (
        gathered(df, partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def missing_rows(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key the table does not hold yet."""
    return df.join(existing.select(*keys), keys, "left_anti")


def seed(
    df: DataFrame, path: str, ddl: str, keys: list[str], partition_cols: list[str] | None = None
) -> None:
    """K-4: insert the rows whose key is missing.

    An empty table takes everything; a rerun, or a run after a half-written
    seed, adds only what is absent.
    """
    existing = read_parquet_or_empty(df.sparkSession, path, ddl)
    if existing.isEmpty():
        append(df, path, partition_cols)
    else:
        append(missing_rows(df, existing, keys), path, partition_cols)


def describe(df: DataFrame) -> DataFrame:
    """D-7: the schema as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, col_name STRING, data_type STRING")


def partition_listing(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """D-4: rows, files and bytes per partition.

    Only partition values and file metadata are read. Grouping by file first
    keeps one row per file, so a partition with most of the rows is no burden.
    """
    files = df.groupBy(
        *partition_cols,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
    return files.groupBy(*partition_cols).agg(
        F.sum("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size").alias("total_bytes"),
    )
