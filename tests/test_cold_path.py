import random

import pytest
from helpers import DAY_MS, random_ticks, rows, ticks
from pyspark.sql import functions as F
from test_streaming import envelopes

from barlake import schemas
from barlake.operators import bars, upsert
from barlake.operators.quality import QualityGateError
from barlake.plans import cold_path
from barlake.sources import messages, tables
from barlake.sources.dimensions import generate_dim_date
from barlake.storage import remove_tree

TOPICS = ["stock_trades"]


def seed_assets(spark, lake, symbols=("A", "B")):
    data = [(s, s.lower(), "stock", "USD") for s in symbols]
    tables.append(spark.createDataFrame(data, schemas.DIM_ASSETS_DDL), lake.assets, ["asset_type"])


def run(spark, lake, data, **options):
    envelopes(ticks(spark, data)).write.mode("append").json(f"{lake.root}/broker")
    stream = messages.file_stream(spark, f"{lake.root}/broker")
    cold_path.run_cold_path(spark, lake, stream, TOPICS, **options)


def fact(spark, lake):
    stored = spark.read.schema(schemas.FACT_TABLE_DDL).parquet(lake.fact)
    return rows(stored.select(*bars.FACT_COLUMNS), "symbol", "date_key")


@pytest.mark.parametrize("pieces", [1, 3])
def test_any_split_gives_the_same_fact(spark, folder, pieces):
    data = random_ticks(11, 200)
    random.Random(1).shuffle(data)
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    for k in range(pieces):
        run(spark, lake, data[k::pieces])
    expected = bars.fact_daily_prices(ticks(spark, data), generate_dim_date(spark))
    assert fact(spark, lake) == rows(expected, "symbol", "date_key")
    gold = spark.read.schema(schemas.GOLD_DDL).parquet(lake.gold)
    assert {r.symbol for r in gold.select("symbol").distinct().collect()} == {"A", "B"}


def test_a_late_day_corrects_the_following_return(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    run(spark, lake, [("A", 10.0, 1.0, 0, 0), ("A", 30.0, 1.0, 2 * DAY_MS, 1)])
    assert [r[7] for r in fact(spark, lake)] == [0.0, pytest.approx(200.0)]
    run(spark, lake, [("A", 20.0, 1.0, DAY_MS, 2)])
    assert [r[7] for r in fact(spark, lake)] == [0.0, pytest.approx(100.0), pytest.approx(50.0)]


def test_replayed_silver_batch_changes_nothing(spark, folder):
    lake = cold_path.Lake(folder)
    batch = envelopes(ticks(spark, random_ticks(12, 60)))
    step = cold_path.silver_batch(lake, TOPICS)
    step(batch, 0)
    before = fact(spark, lake)
    step(batch, 0)
    assert fact(spark, lake) == before


def test_dead_letters_are_kept_and_counted_once(spark, folder):
    lake = cold_path.Lake(folder)
    good = envelopes(ticks(spark, [("A", 1.0, 1.0, 0, 0)]))
    bad = good.withColumns({"value": F.lit("{"), "offset": F.lit(1).cast("bigint")})
    step = cold_path.silver_batch(lake, TOPICS)
    for _ in range(2):
        step(good.unionByName(bad), 0)
    dead = spark.read.json(lake.dead_letters)
    assert [(r.value, r.reason) for r in dead.collect()] == [("{", "unparseable")]


def test_batch_of_dead_letters_only(spark, folder):
    lake = cold_path.Lake(folder)
    bad = envelopes(ticks(spark, [("A", -1.0, 1.0, 0, 0)]))
    cold_path.silver_batch(lake, TOPICS)(bad, 0)
    assert tables.read_parquet_or_empty(spark, lake.fact, schemas.FACT_TABLE_DDL).count() == 0


def test_backfill_replaces_a_range_and_its_successor(spark, folder):
    lake = cold_path.Lake(folder)
    data = [("A", float(10 * (d + 1)), 1.0, d * DAY_MS, d) for d in range(4)]
    cold_path.silver_batch(lake, TOPICS)(envelopes(ticks(spark, data)), 0)
    fixed = [("A", 40.0, 2.0, DAY_MS, 9)]
    cold_path.backfill(spark, lake, ticks(spark, fixed), "2024-01-02", "2024-01-02")
    got = [(r[1], r[5], r[6], round(r[7], 6)) for r in fact(spark, lake)]
    assert got == [
        (20240101, 10.0, 1, 0.0),
        (20240102, 40.0, 2, 300.0),
        (20240103, 30.0, 1, -25.0),
        (20240104, 40.0, 1, 33.333333),
    ]


def test_gate_stops_the_load(spark, folder):
    lake = cold_path.Lake(folder)
    wrong = bars.daily_ohlcv(ticks(spark, [("A", 5.0, 1.0, 0, 0)])).withColumn(
        "low_price", F.lit(9.0)
    )
    with pytest.raises(QualityGateError):
        cold_path.upsert_bars(spark, lake, wrong)
    assert tables.read_parquet_or_empty(spark, lake.fact, schemas.FACT_TABLE_DDL).count() == 0


def test_errors_propagate_and_the_sync_is_made_up_for(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)

    def failing(rows_to_write):
        raise RuntimeError("serving table is down")

    with pytest.raises(RuntimeError, match="down"):
        run(spark, lake, [("A", 1.0, 1.0, 0, 0)], write_gold=failing)
    cold_path.silver_to_gold(spark, lake)
    assert spark.read.parquet(lake.gold).count() == 1


def test_only_due_months_are_synced(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    seen = []

    def write(rows_to_write):
        seen.append(sorted(r.fetch_date.month for r in rows_to_write.collect()))

    step = cold_path.silver_batch(lake, TOPICS)
    step(envelopes(ticks(spark, [("A", 1.0, 1.0, d * DAY_MS, d) for d in (0, 40)])), 0)
    cold_path.silver_to_gold(spark, lake, write)
    cold_path.silver_to_gold(spark, lake, write)
    step(envelopes(ticks(spark, [("A", 2.0, 1.0, 41 * DAY_MS, 9)])), 1)
    cold_path.silver_to_gold(spark, lake, write)
    cold_path.silver_to_gold(spark, lake, write, everything=True)
    assert seen == [[1, 2], [2, 2], [1, 2, 2]]


def test_a_batch_that_died_while_publishing_is_not_counted_twice(spark, folder, monkeypatch):
    lake = cold_path.Lake(folder)
    step = cold_path.silver_batch(lake, TOPICS)
    step(envelopes(ticks(spark, [("A", 1.0, 5.0, 0, 0)])), 0)
    second = envelopes(ticks(spark, [("A", 2.0, 7.0, 1, 1), ("B", 3.0, 1.0, 0, 2)]))

    def die(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(upsert, "_publish", die)
        with pytest.raises(OSError):
            step(second, 1)
    assert [r[6] for r in fact(spark, lake)] == [5]
    step(second, 1)
    assert [(r[0], r[5], r[6]) for r in fact(spark, lake)] == [("A", 2.0, 12), ("B", 3.0, 1)]


def test_later_batches_merge_with_backfilled_bars(spark, folder):
    lake = cold_path.Lake(folder)
    step = cold_path.silver_batch(lake, TOPICS)
    step(envelopes(ticks(spark, [("A", 1.0, 5.0, 10, 0)])), 3)
    cold_path.backfill(
        spark, lake, ticks(spark, [("A", 1.5, 6.0, 10, 0)]), "2024-01-01", "2024-01-01"
    )
    assert [(r[2], r[6]) for r in fact(spark, lake)] == [(1.5, 6)]
    step(envelopes(ticks(spark, [("A", 9.0, 1.0, 20, 1), ("A", 8.0, 1.0, 0, 2)])), 4)
    assert [(r[2], r[5], r[6]) for r in fact(spark, lake)] == [(8.0, 9.0, 8)]


def test_a_new_checkpoint_is_noticed(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    run(spark, lake, [("A", 10.0, 1.0, 0, 0)])
    run(spark, lake, [("A", 11.0, 1.0, 1, 1)])
    remove_tree(spark, lake.checkpoint("bronze_to_silver"))
    with pytest.raises(Exception, match="checkpoint is gone"):
        run(spark, lake, [("A", 99.0, 5.0, 2, 2)])
    for path in (lake.fact, lake.progress, lake.checkpoint("bronze_to_silver")):
        remove_tree(spark, path)
    run(spark, lake, [("A", 12.0, 1.0, 3, 3)])
    (bar,) = spark.read.parquet(lake.fact).collect()
    assert (bar.high_price, bar.volume) == (99.0, 8)


def test_unlisted_topics_and_bad_positions_are_dead_letters(spark, folder):
    lake = cold_path.Lake(folder)
    batch = envelopes(ticks(spark, [("A", 1.0, 1.0, 0, 0), ("A", 2.0, 1.0, 1, 1), ("A", 3.0, 1.0, 2, 2)]))
    batch = batch.withColumns(
        {
            "topic": F.when(F.col("offset") == 1, "other").otherwise(F.col("topic")),
            "partition": F.when(F.col("offset") == 2, F.lit(None).cast("int")).otherwise(F.col("partition")),
        }
    )
    cold_path.silver_batch(lake, TOPICS)(batch, 0)
    reasons = {r.reason for r in spark.read.json(lake.dead_letters).collect()}
    assert reasons == {"unknown_topic", "bad_position"}
    assert spark.read.parquet(lake.fact).count() == 1
