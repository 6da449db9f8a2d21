"""Table maintenance (D-4..D-6, D-9)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.upsert import (
    complete_pending,
    discard_staging,
    stage_partitions,
    staged_path,
    touched_rows,
)
from barlake.storage import remove_tree

TARGET_FILE_BYTES = 128 * 1024 * 1024

RESULT_DDL = "table_name STRING, step STRING, before BIGINT, after BIGINT, error STRING"


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Data files below a path. The content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(F.col("path").alias("file_path"), "modificationTime", "length")
    )


# Fixed value: the folder of the null partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_of(file_path: str, partition_cols: list[str]) -> list[Column]:
    """Partition values, as text, out of a file path; null for the null partition."""
    return [
        F.nullif(
            F.url_decode(F.regexp_extract(file_path, f"/{c}=([^/]*)/", 1)), F.lit(NULL_PARTITION)
        ).alias(c)
        for c in partition_cols
    ]


def file_sizes(spark: SparkSession, path: str, partition_cols: list[str]) -> DataFrame:
    """Files, bytes and small files per partition, from the listing alone."""
    return (
        list_files(spark, path)
        .select(*partition_of("file_path", partition_cols), "length")
        .groupBy(*partition_cols)
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.sum("length").alias("total_bytes"),
        )
    )


def needs_compaction(sizes: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Partitions that a rewrite leaves with fewer files, and how many it should make.

    Files above half the target are left alone, so a rewritten partition is fine
    although its bytes changed a little.
    """
    wanted = F.greatest(F.ceil(F.col("total_bytes") / target_bytes), F.lit(1)).cast("int")
    small = F.col("total_bytes") < F.col("file_count") * (target_bytes / 2)
    return sizes.withColumn("wanted", wanted).filter((F.col("file_count") > F.col("wanted")) & small)


COMPACTION = "compaction"

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Partitioned writes inside keep up to so many files open in a task.

    Otherwise a task first sorts all its rows by partition, and one that writes a large file holds all of it.
    """
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, files)
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def compact(
    spark: SparkSession,
    path: str,
    partition_cols: list[str],
    ddl: str,
    target_bytes: int = TARGET_FILE_BYTES,
    only: Column | None = None,
) -> tuple[int, int]:
    """D-5: rewrite partitions made of too many files; gives files before and after.

    ``only`` limits it to partitions that no other job writes. The rows are staged
    in a folder of their own, compared with the table, and published by as many
    tasks per partition as it should have files.
    """
    complete_pending(spark, path, partition_cols, COMPACTION)
    before = list_files(spark, path).count()
    table = spark.read.schema(ddl).parquet(path)
    crowded = needs_compaction(file_sizes(spark, path, partition_cols), target_bytes).select(
        *[F.col(c).cast(table.schema[c].dataType).alias(c) for c in partition_cols], "wanted"
    )
    if only is not None:
        crowded = crowded.filter(only)
    if crowded.isEmpty():
        return before, before
    chosen = touched_rows(table, crowded, partition_cols)
    staged = staged_path(path, COMPACTION)
    stage_partitions(chosen, path, partition_cols, COMPACTION)
    rows = spark.read.schema(chosen.schema).parquet(staged)
    if content_hash(rows) != content_hash(chosen):
        discard_staging(spark, path, COMPACTION)
        raise RuntimeError(f"the staged copy of {path} differs from the table")
    # Rows of a partition go to "wanted" tasks, chosen by a hash of the row.
    same = [rows[c].eqNullSafe(crowded[c]) for c in partition_cols]
    spread = rows.join(crowded, same).select(
        *[rows[c] for c in rows.columns],
        F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), "wanted").alias("_file"),
    )
    with unsorted_writes(spark):
        (
            spread.repartition(*partition_cols, "_file")
            .drop("_file")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols)
            .parquet(path)
        )
    discard_staging(spark, path, COMPACTION)
    return before, list_files(spark, path).count()


def content_hash(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash of all rows, exact in DECIMAL."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)


def orphan_files(
    spark: SparkSession, path: str, manifest: DataFrame, older_than: datetime | None = None
) -> DataFrame:
    """D-6: listed files that no committed table state refers to, as a report.

    ``manifest`` has the committed ``file_path`` values (see ``committed_files``). Files
    younger than ``older_than`` may belong to a running write and are left out.
    """
    listed = list_files(spark, path)
    if older_than is not None:
        listed = listed.filter(F.col("modificationTime") < F.lit(older_than))
    return listed.join(manifest.select("file_path"), "file_path", "left_anti")


def committed_files(table: DataFrame) -> DataFrame:
    """The files a table read resolves to, as a manifest.

    A read gives encoded addresses and a listing plain paths; the manifest has the latter.
    """
    address = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return table.select(F.url_decode(address).alias("file_path")).distinct()


def sink_files(spark: SparkSession, path: str) -> DataFrame:
    """The files that a stream has committed to a folder.

    A read of the folder itself follows the log that the sink keeps there.
    """
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file_path"))


def sink_orphans(
    spark: SparkSession, path: str, pattern: str = "*.parquet", older_than: datetime | Column | None = None
) -> DataFrame:
    """D-6: files below a stream's folder that its log does not know, left by attempts that failed.

    The folder is listed through a glob, as a plain read of it would show logged files only.
    """
    listed = list_files(spark, f"{path.rstrip('/')}/*", pattern)
    if older_than is not None:
        listed = listed.filter(F.col("modificationTime") < F.lit(older_than))
    return listed.join(sink_files(spark, path), "file_path", "left_anti")


def remove_orphans(spark: SparkSession, path: str, pattern: str, older_than: datetime | Column) -> tuple[int, int]:
    """Delete them, a file at a time; files before and after."""
    before = list_files(spark, f"{path.rstrip('/')}/*", pattern).count()
    gone = 0
    for row in sink_orphans(spark, path, pattern, older_than).select("file_path").toLocalIterator():
        gone += remove_tree(spark, row["file_path"])
    return before, before - gone


def maintain(
    spark: SparkSession, steps: list[tuple[str, str, Callable[[], tuple[int, int]]]]
) -> DataFrame:
    """D-9: run ``(table, step, action)`` in order and go on past failures."""
    results = []
    for table, step, action in steps:
        try:
            before, after = action()
            results.append((table, step, before, after, None))
        except Exception as error:  # reported in the result, row by row
            results.append((table, step, None, None, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(results, RESULT_DDL)
