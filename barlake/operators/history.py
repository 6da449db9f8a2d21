"""Row history with as-of reads (D-1..D-3, D-7, D-8).

A history table carries ``valid_from`` and ``valid_to``, the versions in which a
row appeared and disappeared; ``valid_to`` is null while the row is current.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.maintenance import content_hash
from barlake.operators.upsert import (
    check_unique,
    complete_pending,
    discard_staging,
    stage_partitions,
    staged_path,
    touched_rows,
)
from barlake.sources.tables import read_parquet_or_empty, replace_partitions
from barlake.storage import has_files, materialized, path_exists, remove_tree, rename

FROM, TO = "valid_from", "valid_to"


def start_history(rows: DataFrame, version: int) -> DataFrame:
    """The first version: all rows open."""
    return rows.withColumn(FROM, F.lit(version).cast("bigint")).withColumn(
        TO, F.lit(None).cast("bigint")
    )


def version_changes(
    history: DataFrame,
    rows: DataFrame,
    keys: list[str],
    version: int,
    delete_missing: bool = False,
    unchanged: bool = False,
) -> DataFrame:
    """The history rows a batch closes or adds; with ``unchanged`` all open rows too.

    One join with the open rows. Rows equal to the stored ones change nothing,
    so applying a batch twice is harmless. ``delete_missing`` treats ``rows`` as
    a full snapshot and closes what it lacks.
    """
    values = [c for c in history.columns if c not in (*keys, FROM, TO)]
    opened = history.filter(F.col(TO).isNull()).select(
        *keys, F.struct(*values).alias("old"), F.col(FROM)
    )
    incoming = rows.select(*keys, F.struct(*values).alias("new"))
    sides = "full_outer" if delete_missing or unchanged else "right_outer"
    pairs = opened.join(incoming, keys, sides)
    old, new = F.col("old"), F.col("new")
    at = F.lit(version).cast("bigint")
    never = F.lit(None).cast("bigint")
    replaced = old.isNotNull() & new.isNotNull() & ~old.eqNullSafe(new)
    removed = old.isNotNull() & new.isNull() & F.lit(delete_missing)
    keeps_open = old.isNotNull() & ~replaced & ~removed & F.lit(unchanged)

    def entry(row, start, end):
        return F.struct(row.alias("row"), start.alias(FROM), end.alias(TO))

    entries = F.filter(
        F.array(
            F.when(keeps_open, entry(old, F.col(FROM), never)),
            F.when(replaced | removed, entry(old, F.col(FROM), at)),
            F.when(replaced | old.isNull(), entry(new, at, never)),
        ),
        lambda e: e.isNotNull(),
    )
    return (
        pairs.select(*keys, F.explode(entries).alias("e"))
        .select(*keys, "e.row.*", f"e.{FROM}", f"e.{TO}")
        .select(*history.columns)
    )


def apply_version(
    history: DataFrame,
    rows: DataFrame,
    keys: list[str],
    version: int,
    delete_missing: bool = False,
) -> DataFrame:
    """The whole history after a batch."""
    closed = history.filter(F.col(TO).isNotNull())
    return closed.unionByName(
        version_changes(history, rows, keys, version, delete_missing, unchanged=True)
    )


def store_version(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: list[str],
    version: int,
    partition_cols: list[str],
    ddl: str,
) -> None:
    """Apply a batch to a stored history; only the partitions it touches are rewritten.

    The partition columns must follow from the key. The batch is written once, as its plan may be long; one
    join gives the whole partitions, so they are staged without another merge.
    """
    complete_pending(spark, path, partition_cols)
    history = read_parquet_or_empty(spark, path, ddl)
    with materialized(rows, "version") as batch:
        if batch.isEmpty():
            return
        check_unique(batch, keys)
        touched = touched_rows(history, batch, partition_cols)
        stage_partitions(apply_version(touched, batch, keys, version), path, partition_cols)
    complete_pending(spark, path, partition_cols)


def versions(history: DataFrame) -> DataFrame:
    """D-1: rows that appeared and disappeared in each version."""
    added = history.select(F.col(FROM).alias("version"), F.lit(1).alias("a"), F.lit(0).alias("r"))
    removed = history.filter(F.col(TO).isNotNull()).select(
        F.col(TO).alias("version"), F.lit(0).alias("a"), F.lit(1).alias("r")
    )
    return (
        added.unionByName(removed)
        .groupBy("version")
        .agg(F.sum("a").alias("rows_added"), F.sum("r").alias("rows_removed"))
    )


def as_of(history: DataFrame, version: int) -> DataFrame:
    """D-2: the table as it was at a version."""
    visible = (F.col(FROM) <= version) & (F.col(TO).isNull() | (F.col(TO) > version))
    return history.filter(visible).drop(FROM, TO)


def expire(history: DataFrame, oldest_kept: int) -> DataFrame:
    """D-3: drop rows that no version from ``oldest_kept`` on can see."""
    return history.filter(F.col(TO).isNull() | (F.col(TO) > oldest_kept))


def oldest_retained(history: DataFrame, retain_last: int = 1) -> int | None:
    """The oldest of the last ``retain_last`` versions; None without versions."""
    newest = versions(history).orderBy(F.desc("version")).limit(retain_last)
    return newest.agg(F.min("version")).first()[0]


def expire_versions(history: DataFrame, retain_last: int = 1) -> DataFrame:
    """D-3: keep what the last ``retain_last`` versions can see."""
    oldest = oldest_retained(history, retain_last)
    return history if oldest is None else expire(history, oldest)


def union_layouts(*parts: DataFrame) -> DataFrame:
    """D-7, D-8: one table over folders of different age.

    Columns a folder lacks are null there; each folder may have its own
    partition columns.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


LAYOUT = "layout"


def complete_rewrite(spark: SparkSession, old_path: str, new_path: str, partition_cols: list[str]) -> bool:
    """Finish a rewrite that died after staging; one that died before leaves nothing behind.

    The staged rows go last, so however often it dies, the old folder is never read again once they are whole.
    """
    staged = staged_path(new_path, LAYOUT)
    whole = path_exists(spark, f"{staged}/_SUCCESS")
    if whole:
        replace_partitions(spark.read.parquet(staged), new_path, partition_cols)
        remove_tree(spark, old_path)
    discard_staging(spark, new_path, LAYOUT)
    return whole


def rewrite_layout(
    spark: SparkSession,
    old_path: str,
    new_path: str,
    partition_cols: list[str],
    old_ddl: str,
    new_ddl: str,
    convert: Callable[[DataFrame], DataFrame],
) -> bool:
    """D-8: move the rows of a folder with an old layout into one partitioned anew, and drop the old one.

    ``convert`` gives old rows the columns of the new layout; columns it does not give are null. Rows of
    the new folder stay: the partitions that old rows fall into are staged whole, compared with
    what they were made from, and replaced. Gives whether there was anything to move.
    """
    if complete_rewrite(spark, old_path, new_path, partition_cols) or not has_files(spark, old_path):
        return False
    new = read_parquet_or_empty(spark, new_path, new_ddl)
    moved = convert(spark.read.schema(old_ddl).parquet(old_path))
    moved = new.limit(0).unionByName(moved, allowMissingColumns=True)
    moved = moved.select(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in new.columns])
    both = touched_rows(new, moved, partition_cols).unionByName(moved)
    # Staged without partitions of its own; compared before its marker counts.
    staging = f"{staged_path(new_path, LAYOUT)}-unchecked"
    both.write.mode("overwrite").parquet(staging)
    copied = spark.read.schema(new.schema).parquet(staging)
    if content_hash(copied) != content_hash(both):
        discard_staging(spark, new_path, LAYOUT)
        raise RuntimeError(f"the staged copy of {old_path} differs from its source")
    rename(spark, staging, staged_path(new_path, LAYOUT))
    return complete_rewrite(spark, old_path, new_path, partition_cols)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """D-7: a dropped column is left out on read; the files stay as they are."""
    return df.drop(*names)
