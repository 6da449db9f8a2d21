"""Bronze -> Silver -> Gold (T-11, P-8, P-9, D-10).

Each step drains what is there and stops; a scheduler outside calls
``run_cold_path``. Errors propagate.

Silver is incremental. A micro-batch of bronze is reduced to mergeable bar
parts; they are merged with the stored bars of the same days, and only those
bars and their successors are upserted. The cost follows the new ticks, not the
size of bronze. Each stored bar remembers the last batch it took in, and an
upsert that was staged is completed before anything else, so a replayed batch
counts nothing twice. Offsets taken in are kept as intervals, so messages that are
delivered again, in whichever later batch, count nothing either. Bars that the
dimensions do not know are left out and accounted for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions.ordering import TickOrder, by_offset, by_seq
from barlake.functions.scalars import month_key
from barlake.operators import accounting, redelivery
from barlake.operators import bars as ops
from barlake.operators.quality import bars_report, classify, dead_letters, gate, valid_ticks
from barlake.operators.star import marked_gold
from barlake.operators.upsert import complete_pending, merge_upsert, touched_rows
from barlake.sources.dimensions import generate_dim_date
from barlake.sources.tables import read_parquet_or_empty
from barlake.storage import materialized, path_exists, remove_tree
from barlake.streaming.ingest import write_bronze

# The two feeds.
TOPICS = ["crypto_trades", "stock_trades"]

FACT_PARTITIONS = ["month_key"]
NO_BATCH = -1


@dataclass(frozen=True)
class Lake:
    """Folder layout below one root on shared storage."""

    root: str

    def _under(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self._under("bronze/raw_trades")

    @property
    def dead_letters(self) -> str:
        return self._under("bronze/dead_letters")

    @property
    def fact(self) -> str:
        return self._under("silver/fact_daily_prices")

    @property
    def progress(self) -> str:
        return self._under("silver/progress")

    @property
    def offsets(self) -> str:
        return self._under("silver/offsets")

    @property
    def load_counts(self) -> str:
        return self._under("silver/load_counts")

    @property
    def dropped_symbols(self) -> str:
        return self._under("silver/dropped_symbols")

    @property
    def due_months(self) -> str:
        return self._under("silver/due_months")

    @property
    def assets(self) -> str:
        return self._under("silver/dim_assets")

    @property
    def star(self) -> str:
        """Where the tables of the star schema lie."""
        return self._under("silver")

    @property
    def dim_date(self) -> str:
        return self._under("silver/dim_date")

    @property
    def alerts(self) -> str:
        return self._under("gold/stale_feeds")

    @property
    def gold(self) -> str:
        return self._under("gold/daily_prices")

    @property
    def indicators(self) -> str:
        return self._under("gold/crypto_indicators")

    @property
    def settled_indicators(self) -> str:
        return self._under("gold/settled_indicators")

    @property
    def predictions(self) -> str:
        return self._under("gold/daily_predictions")

    @property
    def models(self) -> str:
        return self._under("models/direction")

    def checkpoint(self, job: str) -> str:
        return self._under(f"checkpoints/{job}")


def ingest(messages: DataFrame, lake: Lake) -> None:
    """Step 1: drain the message stream into bronze, whole.

    The sink is exactly-once per message. Dropping redelivered messages here
    would need a watermark, and with it late messages would be lost.
    """
    write_bronze(messages, lake.bronze, lake.checkpoint("raw_to_bronze")).awaitTermination()


def batch_parts(ticks: DataFrame, batch_id: int, order: TickOrder) -> DataFrame:
    """The bars of one batch of ticks, with all that merging needs."""
    parts = ops.with_key_of_date(ops.combine_parts(ops.bar_parts(ticks, order)))
    return parts.withColumns(
        {"month_key": month_key(F.col("date_key")), "batch_id": F.lit(batch_id).cast("bigint")}
    )


def merge_stored(parts: DataFrame, fact: DataFrame) -> DataFrame:
    """Whole bars: batch parts merged with the stored bars of the same keys.

    A stored bar that already took in the batch, or a later one, is left alone.
    """
    stored = ops.with_fetch_date(touched_rows(fact, parts, FACT_PARTITIONS))
    known = parts.select(*ops.FACT_KEYS, F.col("batch_id").alias("new_batch")).join(
        stored, ops.FACT_KEYS, "inner"
    )
    applied = known.filter(F.col("batch_id") >= F.col("new_batch")).select(*ops.FACT_KEYS)
    fresh = parts.join(applied, ops.FACT_KEYS, "left_anti")
    older = known.filter(F.col("batch_id") < F.col("new_batch")).select(*parts.columns)
    both = fresh.unionByName(older)
    merged = ops.combine_parts(both, also=[F.max("batch_id").alias("batch_id")])
    return ops.with_volume(merged)


@contextmanager
def accounted_parts(
    spark: SparkSession, lake: Lake, parts: DataFrame, batch_id: int
) -> Iterator[DataFrame]:
    """Parts written once, without those outside the date dimension.

    What falls out is counted while they are written. Counting parts, not merged bars, makes a
    repeated batch count the same again.
    """
    counts = accounting.DropCounts("silver", ["no_date"])
    marked = ops.mark_dates(parts, generate_dim_date(spark))
    with materialized(counts.watch(marked), "bar-parts") as stored:
        if counts.total:
            accounting.store_counts(
                spark, counts, stored, batch_id, lake.load_counts, lake.dropped_symbols
            )
        yield accounting.kept_rows(stored)


def upsert_bars(spark: SparkSession, lake: Lake, bars: DataFrame) -> None:
    """Gate whole bars, add returns, and upsert them with their successors."""
    with materialized(bars, "bars") as whole:
        if whole.isEmpty():
            return
        gate(bars_report(whole))
        fact = stored_fact(spark, lake)
        keyed = ops.to_fact(whole, generate_dim_date(spark)).withColumn(
            "month_key", month_key(F.col("date_key"))
        )
        # Noted first: a due month without news does no harm, a missed one would.
        mark_due(keyed, lake)
        rows = ops.refresh_fact(keyed, ops.needed_fact(keyed, fact))
        merge_upsert(
            spark, lake.fact, rows, ops.FACT_KEYS, FACT_PARTITIONS, schemas.FACT_TABLE_DDL
        )


def stored_fact(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_parquet_or_empty(spark, lake.fact, schemas.FACT_TABLE_DDL)


class ProgressLostError(RuntimeError):
    """The fact table was built by a stream whose checkpoint is gone."""


def check_progress(spark: SparkSession, lake: Lake) -> None:
    """Tie the fact table to the stream that fills it.

    Batch numbers guard against counting twice, and they start again with a new
    checkpoint: every tick of a stored bar would then pass for one already counted.
    The id of a stream lives in its checkpoint, so it tells the two apart.
    """
    metadata = f"{lake.checkpoint('bronze_to_silver')}/metadata"
    if not path_exists(spark, metadata):
        return
    current = spark.read.schema("id STRING").json(metadata)
    known = read_parquet_or_empty(spark, lake.progress, "id STRING").first()
    if known is None:
        # A new stream rebuilds the table from all of bronze.
        remove_tree(spark, lake.offsets)
        current.coalesce(1).write.mode("overwrite").parquet(lake.progress)
    elif known["id"] != current.first()["id"]:
        raise ProgressLostError(
            f"{lake.fact} was filled by stream {known['id']}, whose checkpoint is gone. Remove"
            f" {lake.fact} and {lake.progress}: the new stream then rebuilds it from bronze"
        )


def silver_batch(lake: Lake, topics: list[str]) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of step 2; repeating a batch is harmless."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            check_progress(spark, lake)
        complete_pending(spark, lake.fact, FACT_PARTITIONS)
        classified = classify(batch, topics)
        # Both outputs read the parsed batch; only dead letters need its text.
        # The batch is bounded by the files it takes, and it may spill to disk.
        classified = classified.withColumn("value", F.when(~F.col("is_valid"), F.col("value")))
        classified = classified.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with materialized(redelivery.offset_blocks(classified), "offsets") as blocks:
                seen = redelivery.stored_intervals(spark, lake.offsets, batch_id)
                fresh = redelivery.fresh_messages(classified, blocks, seen)
                write_dead_letters(fresh, lake, batch_id)
                parts = batch_parts(valid_ticks(fresh), batch_id, by_offset(topics))
                with accounted_parts(spark, lake, parts, batch_id) as known:
                    upsert_bars(spark, lake, merge_stored(known, stored_fact(spark, lake)))
                # Last: a batch that died before is repeated, and its bars know its number.
                taken = redelivery.batch_intervals(classified, blocks)
                redelivery.store_intervals(taken, lake.offsets, batch_id)
        finally:
            classified.unpersist()

    return run


def write_dead_letters(classified: DataFrame, lake: Lake, batch_id: int) -> None:
    """K-9: replace the dead letters of a batch."""
    (
        dead_letters(classified)
        .withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .json(lake.dead_letters)
    )


def bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    topics: list[str] | None = None,
    max_files_per_batch: int = 1000,
) -> None:
    """Step 2: process the bronze files no earlier run has seen."""
    (
        spark.readStream.schema(schemas.ENVELOPE_DDL)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(lake.bronze)
        .writeStream.foreachBatch(silver_batch(lake, topics or TOPICS))
        .option("checkpointLocation", lake.checkpoint("bronze_to_silver"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def mark_due(rows: DataFrame, lake: Lake) -> None:
    """Note the months of some bars as due for the serving table."""
    rows.select("month_key").distinct().coalesce(1).write.mode("append").parquet(lake.due_months)


def gold_rows(spark: SparkSession, lake: Lake, months: list[int] | None = None) -> DataFrame:
    """Flat rows of all months or of some (the filter prunes partitions), those without an asset marked."""
    fact = stored_fact(spark, lake)
    if months is not None:
        fact = fact.filter(F.col("month_key").isin(months))
    assets = read_parquet_or_empty(spark, lake.assets, schemas.DIM_ASSETS_DDL)
    return marked_gold(fact, generate_dim_date(spark), assets)


def sync_gold(
    spark: SparkSession, lake: Lake, write: Callable[[DataFrame], None], months: list[int] | None = None
) -> None:
    """Write the flat rows and account for those left out, under the newest batch among them.

    ``write`` must run through all rows it is given.
    """
    counts = accounting.DropCounts("gold", ["no_date", "no_asset"])
    marked = gold_rows(spark, lake, months)
    write(accounting.kept_rows(counts.watch(marked)).drop("batch_id"))
    if counts.total:
        newest = NO_BATCH if counts.newest_batch is None else counts.newest_batch
        accounting.store_counts(
            spark, counts, marked, newest, lake.load_counts, lake.dropped_symbols
        )


def parquet_gold_writer(lake: Lake) -> Callable[[DataFrame], None]:
    """Upsert of flat rows into a Parquet serving table."""

    def write(rows: DataFrame) -> None:
        merge_upsert(
            rows.sparkSession,
            lake.gold,
            rows.withColumn("year", F.year("fetch_date")),
            ["symbol", "fetch_date"],
            ["year"],
            f"{schemas.GOLD_DDL}, year INT",
        )

    return write


def silver_to_gold(
    spark: SparkSession,
    lake: Lake,
    write: Callable[[DataFrame], None] | None = None,
    everything: bool = False,
) -> None:
    """Step 3: flatten the months that are due and hand them to the serving table.

    Months stay due until the write succeeded, so a failed sync is made up for by
    the next one. ``everything`` ignores the list and syncs the whole table.
    """
    write = write or parquet_gold_writer(lake)
    due = read_parquet_or_empty(spark, lake.due_months, "month_key INT")
    # Files noted while this sync runs are left for the next one.
    noted = due.inputFiles()
    if everything:
        sync_gold(spark, lake, write)
    elif noted:
        # At most one row per calendar month.
        months = [row["month_key"] for row in due.distinct().collect()]
        sync_gold(spark, lake, write, months)
    for file in noted:
        remove_tree(spark, file)


def run_cold_path(
    spark: SparkSession,
    lake: Lake,
    messages: DataFrame,
    topics: list[str] | None = None,
    write_gold: Callable[[DataFrame], None] | None = None,
) -> None:
    """T-11: the three steps in order."""
    ingest(messages, lake)
    bronze_to_silver(spark, lake, topics)
    silver_to_gold(spark, lake, write_gold)


def backfill(
    spark: SparkSession,
    lake: Lake,
    ticks: DataFrame,
    first_day: str,
    last_day: str,
    order: TickOrder | None = None,
) -> None:
    """D-10: rebuild the bars of a date range from all its ticks and upsert them.

    Rebuilt bars keep the number of the last batch they had taken in. The order
    must lead with the time, or later ticks could not be compared with it.
    """
    order = order or by_seq()
    if not order.sources:
        raise ValueError("a backfill needs an order that leads with the time of day")
    complete_pending(spark, lake.fact, FACT_PARTITIONS)
    in_range = ops.in_days(ticks, first_day, last_day)
    parts = batch_parts(in_range, NO_BATCH, order)
    with accounted_parts(spark, lake, parts, NO_BATCH) as known:
        batches = touched_rows(stored_fact(spark, lake), known, FACT_PARTITIONS).select(
            *ops.FACT_KEYS, F.col("batch_id").alias("last_batch")
        )
        rebuilt = known.join(batches, ops.FACT_KEYS, "left").withColumn(
            "batch_id", F.coalesce("last_batch", "batch_id")
        )
        upsert_bars(spark, lake, ops.with_volume(rebuilt).drop("last_batch", *ops.FACT_KEYS[1:]))
