from helpers import DAY_MS, rows, ticks
from test_cold_path import TOPICS, seed_assets
from test_streaming import envelopes

from barlake.operators import accounting
from barlake.plans import cold_path

OLD = -9000 * DAY_MS  # before the date dimension


def report(spark, lake):
    found = accounting.load_report(spark, lake.load_counts, lake.dropped_symbols)
    return rows(found, "step", "batch_id", "reason")


def test_dropped_bars_are_counted_per_batch_and_reason(spark, folder):
    lake = cold_path.Lake(folder)
    seed_assets(spark, lake)
    step = cold_path.silver_batch(lake, TOPICS)
    step(envelopes(ticks(spark, [("A", 1.0, 1.0, 0, 0), ("X", 1.0, 1.0, 0, 1), ("X", 1.0, 1.0, DAY_MS, 2)])), 0)
    late = [("A", 1.0, 1.0, OLD, 3), ("A", 2.0, 1.0, OLD + DAY_MS, 4), ("B", 1.0, 1.0, OLD, 5), ("B", 1.0, 1.0, 0, 6)]
    for _ in range(2):
        step(envelopes(ticks(spark, late)), 1)
    cold_path.silver_to_gold(spark, lake)
    assert report(spark, lake) == [
        ("gold", 1, "no_asset", 4, 2, 1),
        ("gold", 1, "no_date", 4, 0, 0),
        ("silver", 0, "no_date", 3, 0, 0),
        ("silver", 1, "no_date", 4, 3, 2),
    ]
    symbols = spark.read.parquet(lake.dropped_symbols).filter("step = 'silver'")
    assert rows(symbols.select("symbol", "dropped_bars")) == [("A", 2), ("B", 1)]


def test_nothing_to_account_for(spark, folder):
    lake = cold_path.Lake(folder)
    cold_path.silver_batch(lake, TOPICS)(envelopes(ticks(spark, [("A", -1.0, 1.0, 0, 0)])), 0)
    cold_path.silver_to_gold(spark, lake)
    cold_path.silver_to_gold(spark, lake, everything=True)
    assert report(spark, lake) == []


def test_rows_left_out_by_both_dimensions(spark):
    bars = spark.createDataFrame([("A", 1), ("A", 2), ("X", 2), (None, 1)], "symbol string, day int")
    days = spark.createDataFrame([(1,)], "day int")
    assets = spark.createDataFrame([("A",)], "symbol string")
    marked = accounting.mark_missing(bars, days, "day", "no_day")
    marked = accounting.mark_missing(marked, assets, "symbol", "no_asset")
    assert rows(marked.select("symbol", "day", accounting.REASON)) == [
        (None, 1, "no_asset"), ("A", 1, None), ("A", 2, "no_day"), ("X", 2, "no_day"),
    ]
    counts = accounting.DropCounts("step", ["no_day", "no_asset"])
    assert accounting.kept_rows(counts.watch(marked)).count() == 1
    assert (counts.total, counts.dropped()) == (4, {"no_day": 2, "no_asset": 1})
