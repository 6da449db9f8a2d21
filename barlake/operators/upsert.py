"""Upserts into plain Parquet tables (K-5, D-11).

The merge rewrites only the partitions the source touches. It is written once, to a
staging folder next to the table and laid out like it, whose partition folders then
take the place of the table's; a run that dies in between is completed by the next one. One writer
per table at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.quality import duplicate_keys, keep_latest
from barlake.sources.tables import gathered, replace_partitions
from barlake.storage import has_files, move_partitions, path_exists, remove_tree

# Up to this many touched partitions also prune the scan of the target, as literals.
MAX_LITERAL_PARTITIONS = 2000


class DuplicateKeyError(ValueError):
    """The source of an upsert holds a key twice."""


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """K-5 as an expression: source rows replace target rows of the same key.

    Columns the source lacks keep the target's value on matched rows and are
    null on inserted ones.
    """
    kept = null_safe_join(target, source, keys, "left_anti")
    extra = [c for c in target.columns if c not in source.columns]
    if extra:
        source = source.join(target.select(*keys, *extra), keys, "left")
    return kept.unionByName(source.select(*target.columns)).select(*target.columns)


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    version: str = "version",
    op: str = "op",
    delete: str = "d",
) -> DataFrame:
    """D-11: the newest change of each key wins; deletes remove the row. Null is a key like others."""
    latest = keep_latest(changes, keys, F.col(version))
    kept = null_safe_join(target, latest, keys, "left_anti")
    alive = latest.filter(F.col(op) != delete)
    return kept.unionByName(alive.select(*target.columns)).select(*target.columns)


def merge_statement(
    target: str, source: str, keys: list[str], columns: list[str], partition_cols: tuple[str, ...] = ()
) -> str:
    """K-5 as one MERGE, for tables of a catalog that can update rows.

    Null is a key like others. Naming the partition columns, which follow from the key, lets the
    table prune what it reads.
    """
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    matched = [f"t.{quoted(c)} <=> s.{quoted(c)}" for c in (*keys, *partition_cols)]
    updates = [f"t.{quoted(c)} = s.{quoted(c)}" for c in columns if c not in keys]
    names = ", ".join(quoted(c) for c in columns)
    values = ", ".join(f"s.{quoted(c)}" for c in columns)
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(updates)}" if updates else ""
    return (
        f"MERGE INTO {target} t USING {source} s ON {' AND '.join(matched)}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def supports_merge(spark: SparkSession, table: str) -> bool:
    """Whether the catalog's table takes row-level changes; file tables do not."""
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").first()
    plain = {"parquet", "orc", "csv", "json", "text", "avro", "hive"}
    return provider is not None and provider["data_type"].lower() not in plain


def merge_table(
    spark: SparkSession, table: str, source: DataFrame, keys: list[str], partition_cols: tuple[str, ...] = ()
) -> None:
    """K-5 into a catalog table that can; raises for one that cannot."""
    if not supports_merge(spark, table):
        raise ValueError(f"{table} takes no MERGE; use merge_upsert on its folder")
    check_unique(source, keys)
    view = f"merge_source_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view, keys, source.columns, partition_cols))
    finally:
        spark.catalog.dropTempView(view)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join for which null equals null."""
    side = right.select(*[F.col(c).alias(f"__{c}") for c in keys])
    equal = reduce(lambda a, b: a & b, [left[c].eqNullSafe(side[f"__{c}"]) for c in keys])
    return left.join(side, equal, how)


def _pruning(partitions: list, columns: list[str]) -> Column:
    """What the touched partitions allow each column to be; null is a value like others."""

    def allowed(column: str) -> Column:
        values = {row[column] for row in partitions}
        known = F.col(column).isin([v for v in values if v is not None])
        if None not in values:
            return known
        return F.col(column).isNull() | known if len(values) > 1 else F.col(column).isNull()

    return reduce(lambda a, b: a & b, [allowed(c) for c in columns])


def touched_rows(target: DataFrame, source: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Target rows in the partitions that occur in the source, the null partition included.

    One null-safe join decides for any number of partitions; where they are few, literals
    on top of it prune the scan.
    """
    touched = source.select(*partition_cols).distinct()
    partitions = touched.limit(MAX_LITERAL_PARTITIONS + 1).collect()
    if not partitions:
        return target.limit(0)
    if len(partitions) <= MAX_LITERAL_PARTITIONS:
        target = target.filter(_pruning(partitions, partition_cols))
    return null_safe_join(target, touched, partition_cols, "left_semi")


def check_unique(source: DataFrame, keys: list[str]) -> None:
    duplicate = duplicate_keys(source, keys).first()
    if duplicate is not None:
        raise DuplicateKeyError(f"source holds a key more than once: {duplicate.asDict()}")


def _staging_root(path: str, job: str = "staging") -> str:
    return f"{path.rstrip('/')}__{job}"


def staged_path(path: str, job: str = "staging") -> str:
    """Where rows wait to replace the partitions they belong to."""
    return f"{_staging_root(path, job)}/merged"


def discard_staging(spark: SparkSession, path: str, job: str = "staging") -> None:
    remove_tree(spark, _staging_root(path, job))


def stage_partitions(rows: DataFrame, path: str, partition_cols: list[str], job: str = "staging") -> None:
    """Write what is to replace the partitions of its rows, laid out as the table is."""
    staged = gathered(rows, partition_cols)
    staged.write.mode("overwrite").partitionBy(*partition_cols).parquet(staged_path(path, job))


def _publish(spark: SparkSession, staged: str, path: str, partition_cols: list[str]) -> None:
    moved = move_partitions(spark, staged, path, len(partition_cols))
    if not moved and has_files(spark, staged):
        # Staged without partition folders, as releases before did.
        replace_partitions(spark.read.parquet(staged), path, partition_cols)


def complete_pending(
    spark: SparkSession, path: str, partition_cols: list[str], job: str = "staging"
) -> bool:
    """Finish a rewrite that died after staging. Repeating it changes nothing."""
    if not path_exists(spark, _staging_root(path, job)):
        return False
    pending = path_exists(spark, f"{staged_path(path, job)}/_SUCCESS")
    if pending:
        _publish(spark, staged_path(path, job), path, partition_cols)
    discard_staging(spark, path, job)
    return pending


def merge_upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    ddl: str,
) -> None:
    """K-5: update rows whose key exists, insert the others.

    The partition columns must follow from the key, so that both versions of a
    row lie in the same partition.
    """
    complete_pending(spark, path, partition_cols)
    # The source is materialised once: its plan may be long, and it is used
    # three times below.
    source_path = f"{_staging_root(path)}/source-{uuid.uuid4().hex}"
    source.write.parquet(source_path)
    staged = spark.read.schema(source.schema).parquet(source_path)
    if not has_files(spark, source_path) or staged.isEmpty():
        discard_staging(spark, path)
        return
    check_unique(staged, keys)
    if has_files(spark, path):
        target = spark.read.schema(ddl).parquet(path)
        merged = merge_rows(touched_rows(target, staged, partition_cols), staged, keys)
    else:
        merged = staged
    stage_partitions(merged, path, partition_cols)
    complete_pending(spark, path, partition_cols)
