"""Small helpers over the Hadoop file system Spark already uses."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barlake.session import shared_dir


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove_tree(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.delete(hadoop_path, True)


def move_partitions(spark: SparkSession, source: str, target: str, depth: int) -> int:
    """Put the partition folders of one table in the place of those of another; gives their number.

    Only names change, no row is read. Each folder replaces its counterpart by itself, and those already moved are
    no longer in the source, so a run that dies is completed by repeating it.
    """
    fs, root = _file_system(spark, source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = fs.globStatus(path(f"{source.rstrip('/')}/{'/'.join(['*=*'] * depth)}")) or []
    base = fs.makeQualified(root).toString().rstrip("/")
    for status in found:
        folder = status.getPath()
        place = path(target.rstrip("/") + folder.toString()[len(base) :])
        fs.mkdirs(place.getParent())
        fs.delete(place, True)
        if not fs.rename(folder, place):
            raise OSError(f"could not move {folder.toString()}")
    return len(found)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, hadoop_path = _file_system(spark, old)
    if not fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds at least one data file, at any depth."""
    if not path_exists(spark, path):
        return False
    fs, hadoop_path = _file_system(spark, path)
    root = fs.makeQualified(hadoop_path).toString()
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        below = files.next().getPath().toString()[len(root) :].split("/")
        if not any(part.startswith(("_", ".")) for part in below):
            return True
    return False


# Open scopes; a path belongs to all that are open when it is made.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession, keep: Callable[[], list[str]] = list) -> Iterator[None]:
    """Remove the scratch paths made inside, but for those that ``keep`` names at the end.

    For whoever writes the results that are still read from them; one thread at a time.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]
        for path in set(made) - set(keep()):
            remove_tree(spark, path)


@contextmanager
def materialized(df: DataFrame, name: str, options: dict[str, str] | None = None) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, gone afterwards.

    Unlike a cache it survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_tree(df.sparkSession, path)
