import random
import re

import pandas as pd
import pytest
from helpers import BASE_MS, DAY_MS, plan_of, random_ticks, rows, ticks
from pyspark.sql import functions as F

from barlake.functions.scalars import event_time
from barlake.operators import forecasting as fc
from barlake.operators import indicators as ind


def bar_series(spark, closes, symbol="A"):
    data = [(symbol, i, float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "symbol STRING, i INT, close_price DOUBLE").withColumn(
        "fetch_date", F.date_add(F.lit("2000-01-01").cast("date"), F.col("i"))
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_panes_equal_windows(spark, seed):
    df = ticks(spark, random_ticks(seed, count=400, days=1))
    panes = ind.sliding_indicators(df)
    windows = ind.window_aggregates(df.withColumn("event_time", event_time()))
    rounded = [
        x.withColumns({c: F.round(c, 9) for c in ("sma", "vwap")}) for x in (panes, windows)
    ]
    assert rows(rounded[0]) == rows(rounded[1])


def test_vwap_without_volume_is_the_mean(spark):
    df = ticks(spark, [("A", 10.0, 0.0, 0, 0), ("A", 20.0, 0.0, 1, 1)])
    got = ind.sliding_indicators(df, 10, 10).collect()
    assert [(r.sma, r.vwap, r.trade_count) for r in got] == [(15.0, 15.0, 2)]


def test_null_prices_are_not_counted(spark):
    df = ticks(spark, [("A", None, 1.0, 0, 0), ("A", 20.0, 1.0, 1, 1)])
    assert [r.trade_count for r in ind.sliding_indicators(df, 10, 10).collect()] == [1]


def test_width_must_be_a_multiple_of_the_slide(spark):
    with pytest.raises(ValueError):
        ind.sliding_indicators(ticks(spark, []), 60, 7)


@pytest.mark.parametrize("threshold", [120, 3600, 7777, 200_000])
def test_gaps_equal_brute_force(spark, threshold):
    rng = random.Random(threshold)
    data = [
        (rng.choice("AB"), 1.0, 1.0, rng.randrange(0, 3 * DAY_MS, 1000), n) for n in range(150)
    ]
    data += [("C", 1.0, 1.0, 0, 500), ("C", 1.0, 1.0, threshold * 1000, 501)]
    expected = []
    for symbol in "ABC":
        times = sorted(t for s, _, _, t, _ in data if s == symbol)
        expected += [
            (symbol, (b - a) / 1000)
            for a, b in zip(times, times[1:], strict=False)
            if b - a > threshold * 1000
        ]
    got = ind.feed_gaps(ticks(spark, data), threshold)
    assert sorted((r.symbol, r.gap_seconds) for r in got.collect()) == sorted(expected)


def test_gap_search_never_windows_raw_ticks(spark):
    plan = ind.feed_gaps(ticks(spark, random_ticks(1)))._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    windows = [i for i, line in enumerate(lines) if "Window" in line]
    assert windows
    for i in windows:
        assert "Aggregate" in "".join(lines[i + 1 :])


@pytest.mark.parametrize("n", [1, 2, 5, 20, 200])
def test_ema_equals_the_recurrence(spark, n):
    rng = random.Random(n)
    closes = [100 + rng.random() * 50 for _ in range(700)]
    got = ind.with_ema(bar_series(spark, closes), n).orderBy("i").collect()
    expected = pd.Series(closes).ewm(span=n, adjust=False).mean()
    assert [r[f"ema_{n}"] for r in got] == pytest.approx(list(expected), rel=1e-12)


def test_moving_average_needs_full_frames(spark):
    got = ind.with_moving_averages(bar_series(spark, [1, 2, 3, 4]), (3,)).orderBy("i").collect()
    assert [r.sma_3 for r in got] == [None, None, 2.0, 3.0]


def test_rsi_edges(spark):
    up = ind.with_rsi(bar_series(spark, range(1, 20))).orderBy("i").collect()
    assert [r.rsi_14 for r in up[:14]] == [None] * 14
    assert (up[14].rsi_14, up[14].rsi_signal) == (100.0, -1)
    down = ind.with_rsi(bar_series(spark, range(30, 10, -1))).orderBy("i").collect()
    assert (down[-1].rsi_14, down[-1].rsi_signal) == (0.0, 1)
    flat = ind.with_rsi(bar_series(spark, [5] * 20)).orderBy("i").collect()
    assert (flat[-1].rsi_14, flat[-1].rsi_signal) == (50.0, 0)


def test_step_returns_and_volatility(spark):
    closes = [100 * 1.01**i for i in range(30)]
    frame = ind.with_volatility(ind.with_step_returns(bar_series(spark, closes)))
    last = frame.orderBy("i").collect()[-1]
    assert last.return_1 == pytest.approx(0.01)
    assert last.return_4 == pytest.approx(1.01**4 - 1)
    assert last.volatility_20 == pytest.approx(0.0, abs=1e-12)


def test_volume_anomaly_flags_the_outlier(spark):
    volumes = [100 + i % 3 for i in range(25)] + [100_000]
    bars = bar_series(spark, volumes).withColumnRenamed("close_price", "volume")
    got = ind.with_volume_anomaly(bars).orderBy("i").collect()
    assert [r.is_abnormal for r in got] == [False] * 25 + [True]
    assert got[19].volume_z is None and got[20].volume_z is not None


def test_ranks(spark):
    got = ind.with_ranks(bar_series(spark, [5, 7, 7, 1]), "close_price").orderBy("i").collect()
    assert [(r["row_number"], r["rank"], r["dense_rank"]) for r in got] == [
        (3, 3, 2),
        (1, 1, 1),
        (2, 1, 1),
        (4, 4, 3),
    ]


def test_base_time(spark):
    df = ticks(spark, [("A", 1.0, 1.0, 5_000, 0)])
    (window,) = ind.sliding_indicators(df, 10, 10).collect()
    assert window.window_start.timestamp() * 1000 == BASE_MS or window.window_end is not None


def test_ema_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ind, "EMA_DIGITS", 16)
    closes = [100 + (i * 37) % 23 for i in range(400)]
    for n in (2, 5, 20):
        got = ind.with_ema(bar_series(spark, closes), n).orderBy("i").collect()
        mean, expected = closes[0], []
        for i, close in enumerate(closes):
            mean = close if i == 0 else mean + (close - mean) * 2 / (n + 1)
            expected.append(mean)
        assert [r[f"ema_{n}"] for r in got] == pytest.approx(expected, rel=1e-12)


def test_ema_of_length_one_and_after_a_null(spark):
    assert [r.ema_1 for r in ind.with_ema(bar_series(spark, [3, 1, 2]), 1).orderBy("i").collect()] == [3.0, 1.0, 2.0]
    bars = bar_series(spark, [3, 1, 2, 4]).withColumn("close_price", F.when(F.col("close_price") != 2, F.col("close_price")))
    got = [r.ema_3 for r in ind.with_ema(bars, 3).orderBy("i").collect()]
    assert got == [3.0, 2.0, None, None]


def test_emas_of_several_lengths_share_two_sorts(spark):
    bars = bar_series(spark, [float(i % 7 + 1) for i in range(40)])
    both = ind.with_emas(bars, (5, 20, 1))
    assert len(re.findall(r"(?m)^[ :+-]*(?:\*\(\d+\) )?Sort \[", plan_of(both))) <= 2
    apart = ind.with_ema(ind.with_ema(bars, 5), 20)
    for got, expected in zip(both.orderBy("i").collect(), apart.orderBy("i").collect(), strict=True):
        assert (got.ema_5, got.ema_20, got.ema_1) == (expected.ema_5, expected.ema_20, got.close_price)
    # Lengths whose weights fade too slowly for common blocks get their own.
    slow = [r.ema_400 for r in ind.with_emas(bars, (2, 400)).orderBy("i").collect()]
    assert slow == [r.ema_400 for r in ind.with_ema(bars, 400).orderBy("i").collect()]


def test_past_closes_give_what_sliding_frames_give(spark):
    closes = [1.1, 2.7, None, 4.2, 3.3, 3.3, 7.9, 0.1, 5.5, 6.4, 6.4, 6.4, 1.3, 2.2, None, 9.1, 8.7, 2.2, 2.9]
    series = spark.createDataFrame(
        [(s, i, None if c is None else c * k) for s, k in (("A", 1.0), ("B", -3.7)) for i, c in enumerate(closes)],
        "symbol STRING, i INT, close_price DOUBLE",
    ).selectExpr("*", "date_add(DATE '2024-01-01', i) AS fetch_date")
    averages = ind.with_moving_averages(series, (1, 3, 5))
    assert rows(averages) == rows(series.withColumns({f"sma_{n}": ind.moving_average("close_price", n) for n in (1, 3, 5)}))
    for n in (1, 3, 14):
        lagged, sliding = ind._with_lagged_moves(series, n), ind._with_sliding_moves(series, n)
        full = [x.filter(f"_moves = {n}") for x in (lagged, sliding)]
        assert rows(full[0]) == rows(full[1].select(full[0].columns))
    assert {c for c in ind.with_rsi(averages, 3).columns} == {*averages.columns, "rsi_3", "rsi_signal"}


def test_features_of_models_add_up_past_closes(spark):
    bars = spark.range(3).selectExpr(
        "cast(id AS string) AS symbol", "date_add(DATE '2024-01-01', cast(id AS int)) AS fetch_date", "id * 1.0D AS close_price",
        "id AS volume", "id * 0.5D AS daily_return",
    )
    plan = plan_of(fc.feature_frame(bars).select("symbol", "fetch_date", *fc.FEATURES, "target"))
    assert "lag(close_price" in plan and "currentrow$())" not in plan
