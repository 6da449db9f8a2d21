"""What a load leaves out, counted in the pass that writes (Q-4, J-4, P-10, P-11).

Bars without a day in the date dimension do not reach the fact table, bars of symbols without an asset
do not reach the serving table. Rows carry the reason in a column; ``observe`` counts the
reasons while the rows are written, so an ordinary load pays nothing for it. Only when a reason
occurred are the symbols behind it grouped and stored as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.sources.tables import read_parquet_or_empty

REASON = "drop_reason"
KEYS = ["step", "batch_id"]

COUNTS_DDL = "reason STRING, total_bars BIGINT, dropped_bars BIGINT, step STRING, batch_id BIGINT"
SYMBOLS_DDL = "reason STRING, symbol STRING, dropped_bars BIGINT, step STRING, batch_id BIGINT"


def mark_missing(rows: DataFrame, dimension: DataFrame, key: str, reason: str) -> DataFrame:
    """Join a dimension whose ``key`` is unique; rows it lacks stay, with a reason.

    The first reason of a row wins.
    """
    known = dimension.withColumn("_known", F.lit(True))
    joined = rows.join(known, key, "left")
    found = F.when(F.col("_known").isNull(), F.lit(reason))
    earlier = [F.col(REASON)] if REASON in rows.columns else []
    return joined.withColumn(REASON, F.coalesce(*earlier, found)).drop("_known")


def kept_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNull()).drop(REASON)


class DropCounts:
    """The rows of one load by reason; ``watch`` the marked rows, write them, then read the counts."""

    def __init__(self, step: str, reasons: Sequence[str]):
        self.step, self.reasons = step, list(reasons)
        self._observation = Observation()

    def watch(self, marked: DataFrame) -> DataFrame:
        """The same rows; the first action that runs through them fills the counts."""
        newest = F.max("batch_id") if "batch_id" in marked.columns else F.lit(None).cast("bigint")
        return marked.observe(
            self._observation,
            F.count(F.lit(1)).alias("total"),
            newest.alias("newest"),
            *[F.count_if(F.col(REASON) == r).alias(f"r{i}") for i, r in enumerate(self.reasons)],
        )

    @property
    def total(self) -> int:
        # An input known to be empty is not run, so nothing is observed.
        return self._observation.get.get("total", 0)

    @property
    def newest_batch(self) -> int | None:
        """The highest batch number among the rows, where they carry it."""
        return self._observation.get.get("newest")

    def dropped(self) -> dict[str, int]:
        found = self._observation.get
        return {r: found.get(f"r{i}", 0) for i, r in enumerate(self.reasons)}


def store_counts(
    spark: SparkSession, counts: DropCounts, marked: DataFrame, batch_id: int, counts_path: str, symbols_path: str
) -> None:
    """One row per reason, and one per reason and symbol where something was dropped.

    A repeated batch replaces what it stored before.
    """
    dropped = counts.dropped()
    rows = [(r, counts.total, n, counts.step, batch_id) for r, n in dropped.items()]
    _replace(spark.createDataFrame(rows, COUNTS_DDL), counts_path)
    if not any(dropped.values()):
        return
    symbols = (
        marked.filter(F.col(REASON).isNotNull())
        .groupBy(F.col(REASON).alias("reason"), "symbol")
        .agg(F.count(F.lit(1)).alias("dropped_bars"))
        .withColumns({"step": F.lit(counts.step), "batch_id": F.lit(batch_id).cast("bigint")})
    )
    _replace(symbols, symbols_path)


def _replace(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEYS)
        .parquet(path)
    )


def load_report(spark: SparkSession, counts_path: str, symbols_path: str) -> DataFrame:
    """Per step, batch and reason: all bars, dropped bars, and the symbols they belong to."""
    counts = read_parquet_or_empty(spark, counts_path, COUNTS_DDL)
    symbols = read_parquet_or_empty(spark, symbols_path, SYMBOLS_DDL)
    each = symbols.groupBy(*KEYS, "reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(each, [*KEYS, "reason"], "left").select(
        *KEYS, "reason", "total_bars", "dropped_bars", F.coalesce("n", F.lit(0)).alias("dropped_symbols")
    )
