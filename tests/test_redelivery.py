import random
import re

import pytest
from helpers import plan_of, random_ticks, rows, ticks
from pyspark.sql import functions as F
from test_cold_path import TOPICS, fact, run, seed_assets
from test_streaming import envelopes

from barlake.operators import redelivery
from barlake.plans import cold_path

DDL = "topic string, partition int, offset long"


def frame(spark, offsets, topic="a", partition=0):
    return spark.createDataFrame([(topic, partition, o) for o in offsets], DDL)


def intervals(df):
    return [tuple(r) for r in df.select("first_offset", "last_offset").orderBy("first_offset").collect()]


def taken(df):
    return redelivery.batch_intervals(df, redelivery.offset_blocks(df))


def test_intervals_of_holes_blocks_and_sources(spark):
    size = redelivery.BLOCK
    assert intervals(taken(frame(spark, [5, 6, 6, 7, 9, 11, 12]))) == [(5, 7), (9, 9), (11, 12)]
    whole = spark.range(10, 3 * size + 5).selectExpr("'a' AS topic", "0 AS partition", "id AS offset")
    assert intervals(taken(whole)) == [(10, 3 * size + 4)]
    gap = whole.filter((F.col("offset") != size) & (F.col("offset") != 2 * size + 7))
    assert intervals(taken(gap)) == [(10, size - 1), (size + 1, 2 * size + 6), (2 * size + 8, 3 * size + 4)]
    both = frame(spark, [1, 2]).union(frame(spark, [3, 4], partition=1)).union(frame(spark, [5], "b"))
    assert intervals(taken(both)) == [(1, 2), (3, 4), (5, 5)]
    assert intervals(taken(frame(spark, []))) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_fresh_messages_equal_a_set(spark, seed, monkeypatch):
    monkeypatch.setattr(redelivery, "BLOCK", 16)
    rng = random.Random(seed)
    known, batch = ([rng.randrange(200) for _ in range(120)] for _ in range(2))
    before = taken(frame(spark, known)).withColumn("batch_id", F.lit(0))
    messages = frame(spark, batch)
    fresh = redelivery.fresh_messages(messages, redelivery.offset_blocks(messages), before)
    assert sorted(r.offset for r in fresh.collect()) == sorted(set(batch) - set(known))


def test_messages_without_a_place_stay(spark):
    odd = spark.createDataFrame([(None, 0, 1), ("a", None, 1), ("a", 0, None), ("a", 0, -1), ("a", 0, 1), ("a", 0, 1)], DDL)
    blocks = redelivery.offset_blocks(odd)
    before = spark.createDataFrame([("a", 0, 0, 5, 0)], redelivery.INTERVALS_DDL)
    assert redelivery.fresh_messages(odd, blocks, before).count() == 4
    assert redelivery.fresh_messages(odd, blocks, before.limit(0)).count() == 5


def test_fresh_batches_are_not_joined(spark):
    messages = frame(spark, [7, 8])
    before = spark.createDataFrame([("a", 0, 0, 6, 0), ("b", 0, 0, 99, 0)], redelivery.INTERVALS_DDL)
    assert redelivery.fresh_messages(messages, redelivery.offset_blocks(messages), before) is messages


def test_replayed_bronze_files_change_no_volume(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    data = random_ticks(21, 80)
    run(spark, lake, data[:50])
    before = fact(spark, lake)
    run(spark, lake, data[:50])
    assert fact(spark, lake) == before
    run(spark, lake, data[20:] + data[60:])
    lake_2 = cold_path.Lake(f"{folder}/whole")
    cold_path.silver_batch(lake_2, TOPICS)(envelopes(ticks(spark, data)), 0)
    assert fact(spark, lake) == fact(spark, lake_2)


def test_compaction_keeps_the_offsets_and_the_newest_batch(spark, folder):
    path = f"{folder}/offsets"
    for batch, offsets in enumerate(([1, 2, 3], [4, 5], [9], [6, 7])):
        redelivery.store_intervals(taken(frame(spark, offsets)), path, batch)
    before, after = redelivery.compact_intervals(spark, path)
    assert (before, after) == (4, 3)
    stored = redelivery.stored_intervals(spark, path)
    assert rows(stored.select("first_offset", "last_offset", "batch_id")) == [(1, 5, 2), (6, 7, 3), (9, 9, 2)]
    assert redelivery.compact_intervals(spark, path) == (3, 3)


def test_windows_stay_inside_blocks_and_offsets_are_not_compared_in_pairs(spark):
    plan = plan_of(taken(frame(spark, [5, 6, 9])))
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert specs and all("block#" in spec for spec in specs)
    messages, before = frame(spark, range(1, 90, 2)), taken(frame(spark, range(0, 90, 2))).withColumn("batch_id", F.lit(0))
    fresh = redelivery.fresh_messages(messages, redelivery.offset_blocks(messages), before)
    assert not re.search(r"LeftAnti,[^\n]*>=", plan_of(fresh))
    assert fresh.count() == messages.count()


def test_stored_intervals_are_written_by_more_than_one_task(spark, folder):
    plans = spark.range(0, 1000, 1, 4).selectExpr("'a' AS topic", "0 AS partition", "2 * id AS first_offset", "2 * id AS last_offset")
    with_conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    old = {k: spark.conf.get(k) for k in with_conf}
    try:
        for key, value in with_conf.items():
            spark.conf.set(key, value)
        redelivery.store_intervals(plans, folder + "/offsets", 3)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    stored = redelivery.stored_intervals(spark, folder + "/offsets")
    assert stored.count() == 1000 and len(stored.inputFiles()) > 1
