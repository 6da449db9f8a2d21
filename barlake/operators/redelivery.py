"""Messages delivered again in a later batch, or twice in one (A-7, T-8), without a watermark.

What was taken in is kept as intervals of offsets per topic and partition; brokers hand out offsets without
gaps, so a few intervals stand for any number of messages. Offsets are looked at in blocks of
``BLOCK``. One map-side-combined aggregate gives a block's first and last offset, its messages and
(from a bitmap) its different offsets. Only blocks that overlap a stored interval are compared message by message,
only blocks with more messages than offsets are deduplicated, and only blocks with holes are
sorted into intervals. An ordinary batch therefore pays for the aggregate alone, and a partition of a
topic that holds most messages never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.sources.tables import gathered, read_parquet_or_empty
from barlake.storage import remove_tree

# Offsets in a block: as many as bits in one bitmap of ``bitmap_construct_agg``.
BLOCK = 32_768
SOURCE = ["topic", "partition"]
BLOCK_KEYS = [*SOURCE, "block"]

INTERVALS_DDL = "topic STRING, partition INT, first_offset BIGINT, last_offset BIGINT, batch_id BIGINT"


def _block() -> Column:
    return F.floor(F.col("offset") / BLOCK).cast("bigint").alias("block")


def _has_place() -> Column:
    """Whether a message can be told from others at all."""
    return F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.coalesce(F.col("offset") >= 0, F.lit(False))


def offset_blocks(messages: DataFrame) -> DataFrame:
    """First and last offset, messages and different offsets of each block."""
    bits = F.bitmap_construct_agg(F.pmod(F.col("offset"), F.lit(BLOCK)))
    return (
        messages.filter(_has_place())
        .groupBy(*SOURCE, _block())
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count(F.lit(1)).alias("n_messages"),
            F.bitmap_count(bits).alias("n_offsets"),
        )
    )


def _overlaps(blocks: DataFrame, intervals: DataFrame) -> DataFrame:
    """Stored intervals under each of the blocks they reach into.

    An interval is spelt out in blocks only inside the range of its source's blocks, so a long history costs
    no more than the batch.
    """
    ranges = blocks.groupBy(*SOURCE).agg(F.min("block").alias("low"), F.max("block").alias("high"))
    reached = intervals.select(
        *SOURCE,
        F.col("first_offset").alias("seen_first"),
        F.col("last_offset").alias("seen_last"),
        F.floor(F.col("first_offset") / BLOCK).cast("bigint").alias("from_block"),
        F.floor(F.col("last_offset") / BLOCK).cast("bigint").alias("to_block"),
    ).join(ranges, SOURCE)
    steps = F.sequence(F.greatest("from_block", "low"), F.least("to_block", "high"))
    stored = reached.filter((F.col("from_block") <= F.col("high")) & (F.col("to_block") >= F.col("low"))).select(
        *SOURCE, F.explode(steps).alias("block"), "seen_first", "seen_last"
    )
    return (
        blocks.select(*BLOCK_KEYS, "first_offset", "last_offset")
        .join(stored, BLOCK_KEYS)
        .filter((F.col("seen_first") <= F.col("last_offset")) & (F.col("seen_last") >= F.col("first_offset")))
        .select(*BLOCK_KEYS, "seen_first", "seen_last")
    )


def _taken_offsets(placed: DataFrame, seen: DataFrame) -> DataFrame:
    """The offsets of messages that lie in one of their block's intervals.

    Offsets and intervals of a block are sorted together: an offset is taken if an interval that starts no later
    ends no earlier. Blocks can hold thousands of both, so they are not compared in pairs.
    """
    touched = seen.select(*BLOCK_KEYS).distinct()
    offsets = placed.select(*BLOCK_KEYS, "offset").join(touched, BLOCK_KEYS, "left_semi")
    both = offsets.select(
        *BLOCK_KEYS, F.col("offset").alias("_at"), F.lit(None).cast("bigint").alias("_until")
    ).unionByName(seen.select(*BLOCK_KEYS, F.col("seen_first").alias("_at"), F.col("seen_last").alias("_until")))
    # Equal places are one range of the window, so an interval counts for the offset it starts at.
    so_far = Window.partitionBy(*BLOCK_KEYS).orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("_reached", F.max("_until").over(so_far))
        .filter(F.col("_until").isNull() & (F.col("_at") <= F.col("_reached")))
        .select(*SOURCE, F.col("_at").alias("offset"))
    )


def fresh_messages(messages: DataFrame, blocks: DataFrame, intervals: DataFrame) -> DataFrame:
    """The messages whose offset is in no stored interval, one for each offset.

    Messages without a topic, partition or offset cannot be compared and stay. ``blocks`` are those of
    ``messages``; like ``intervals`` they are read more than once, so pass stored ones.
    """
    seen = _overlaps(blocks, intervals)
    repeated = blocks.filter("n_messages > n_offsets").select(*BLOCK_KEYS)
    known, again = not seen.isEmpty(), not repeated.isEmpty()
    if not known and not again:
        return messages
    columns = messages.columns
    placed = messages.withColumn("block", F.when(_has_place(), _block()))
    if known:
        placed = placed.join(_taken_offsets(placed, seen), [*SOURCE, "offset"], "left_anti")
    if again:
        flagged = placed.join(repeated.withColumn("_again", F.lit(True)), BLOCK_KEYS, "left")
        single = flagged.filter(F.col("_again").isNull())
        # Equal but for the time they were delivered at, so any of them will do.
        once = flagged.filter(F.col("_again")).dropDuplicates([*SOURCE, "offset"])
        placed = single.unionByName(once)
    return placed.select(*columns)


def _islands(offsets: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Merge touching or overlapping ranges of each key."""
    ordered = Window.partitionBy(*keys).orderBy(first, last)
    reached = F.max(last).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (F.col(first) > reached + 1), 1).otherwise(0)
    numbered = offsets.withColumn("_starts", starts).withColumn("_island", F.sum("_starts").over(ordered))
    return numbered.groupBy(*keys, "_island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_island")


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """The same offsets in as few intervals as possible."""
    return _islands(intervals.select(*SOURCE, "first_offset", "last_offset"), SOURCE, "first_offset", "last_offset")


def batch_intervals(messages: DataFrame, blocks: DataFrame) -> DataFrame:
    """The intervals of offsets of a batch, merged."""
    whole = blocks.filter("n_offsets = last_offset - first_offset + 1").select(
        *BLOCK_KEYS, "first_offset", "last_offset"
    )
    broken = blocks.filter("n_offsets < last_offset - first_offset + 1").select(*BLOCK_KEYS)
    # At most BLOCK offsets in a window.
    single = (
        messages.filter(_has_place())
        .select(*SOURCE, _block(), "offset")
        .join(broken, BLOCK_KEYS, "left_semi")
        .select(*BLOCK_KEYS, F.col("offset").alias("first_offset"), F.col("offset").alias("last_offset"))
        .distinct()
    )
    islands = _islands(single, BLOCK_KEYS, "first_offset", "last_offset")
    found = whole.unionByName(islands)
    # Only ranges that reach a border of their block can go on in another one: two of a block at most.
    inside = (F.pmod("first_offset", F.lit(BLOCK)) > 0) & (F.pmod("last_offset", F.lit(BLOCK)) < BLOCK - 1)
    parts = found.withColumn("block", F.when(inside, F.col("block")))
    return _islands(parts, BLOCK_KEYS, "first_offset", "last_offset").drop("block")


def stored_intervals(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """Intervals of earlier batches; a batch that is repeated must not find its own."""
    stored = read_parquet_or_empty(spark, path, INTERVALS_DDL)
    return stored if before_batch is None else stored.filter(F.col("batch_id") < before_batch)


def store_intervals(intervals: DataFrame, path: str, batch_id: int) -> None:
    """Replace the intervals of a batch."""
    (
        gathered(intervals.withColumn("batch_id", F.lit(batch_id).cast("bigint")), ["batch_id"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def compact_intervals(spark: SparkSession, path: str) -> tuple[int, int]:
    """Merge the intervals of all batches but the newest; rows before and after.

    The merged rows are written before the old ones go. Should it die in between, both are
    there, and a doubled interval does no harm.
    """
    stored = stored_intervals(spark, path)
    before = stored.count()
    batches = [r["batch_id"] for r in stored.select("batch_id").distinct().orderBy("batch_id").collect()]
    if len(batches) < 3:
        return before, before
    *old, _ = batches
    settled = stored.filter(F.col("batch_id") < batches[-1])
    # Staged first, as it replaces a partition that it reads.
    staging = f"{path.rstrip('/')}__merged"
    remove_tree(spark, staging)
    merged_intervals(settled).write.parquet(staging)
    store_intervals(spark.read.parquet(staging), path, old[-1])
    for batch in old[:-1]:
        remove_tree(spark, f"{path.rstrip('/')}/batch_id={batch}")
    remove_tree(spark, staging)
    return before, stored_intervals(spark, path).count()
