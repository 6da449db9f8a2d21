"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Only what results or plans depend on. Parallelism and memory belong to the
# cluster; AQE sizes the shuffles at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commits upload the changes of a batch, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "barlake", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder; on a cluster no
    other machine would see it, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="barlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
