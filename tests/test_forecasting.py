from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from barlake.operators import forecasting as fc
from barlake.operators import panels
from barlake.operators.bars import with_returns
from barlake.sources.dimensions import generate_dim_date

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def bars(spark):
    data = [
        (s, START + timedelta(days=i), 100.0 + (i * k) % 13 + i * 0.1, 10 + i % 7)
        for k, s in ((3, "A"), (5, "B"))
        for i in range(90)
    ]
    base = spark.createDataFrame(
        data, "symbol STRING, fetch_date DATE, close_price DOUBLE, volume BIGINT"
    ).withColumns({"high_price": F.col("close_price") + 1, "low_price": F.col("close_price") - 1})
    return with_returns(base)


def test_targets_look_one_bar_ahead(bars):
    got = fc.with_targets(bars).filter("symbol = 'A'").orderBy("fetch_date").collect()
    for now, then in zip(got, got[1:], strict=False):
        assert now.next_close == then.close_price
        assert now.target == int(then.close_price > now.close_price)
    assert got[-1].target is None and got[-1].next_close is None


def test_split_is_chronological_without_leakage(bars):
    split = fc.with_split(bars)
    bounds = {
        r.split: (r.lo, r.hi, r.n)
        for r in split.groupBy("split")
        .agg(F.min("fetch_date").alias("lo"), F.max("fetch_date").alias("hi"),
             F.countDistinct("fetch_date").alias("n"))
        .collect()
    }
    assert bounds["train"][1] < bounds["test"][0]
    assert (bounds["train"][2], bounds["test"][2]) == (72, 18)


def test_features_do_not_see_the_future(bars):
    cut = START + timedelta(days=60)
    changed = bars.withColumn(
        "close_price",
        F.when(F.col("fetch_date") > cut, 1.0).otherwise(F.col("close_price")),
    )
    seen = [
        rows(fc.feature_frame(x).filter(F.col("fetch_date") <= cut).select("symbol", *fc.FEATURES))
        for x in (bars, with_returns(changed.drop("prev_close", "daily_return", "price_range")))
    ]
    assert seen[0] == seen[1]


def test_features_share_one_shuffle(bars, spark):
    frame = fc.feature_frame(bars.drop("prev_close", "daily_return", "price_range").withColumn(
        "daily_return", F.lit(0.0)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_train_save_load_predict(bars, spark, folder):
    settings = fc.ModelSettings(max_depth=2, n_estimators=2)
    frame = fc.with_split(fc.feature_frame(bars)).cache()
    model = fc.train_direction(frame.filter("split = 'train'"), settings)
    metrics = spark.createDataFrame([(0.5,)], "accuracy DOUBLE")
    fc.save_model(model, folder, "v1", settings, metrics)
    with pytest.raises(Exception):  # noqa: B017 - a version is never overwritten
        fc.save_model(model, folder, "v1", settings, metrics)
    newest = fc.latest_rows(frame)
    got = fc.predict_direction(
        fc.load_model(folder, "v1"), newest, generate_dim_date(spark), "v1", settings
    ).collect()
    assert {(r.symbol, r.prediction_date) for r in got} == {
        ("A", START + timedelta(days=90)),
        ("B", START + timedelta(days=90)),
    }
    assert all(0.5 <= r.probability <= 1 and r.predicted_direction in (0, 1) for r in got)
    stored = spark.read.json(f"{folder}/v1/metrics").first()
    assert (stored.accuracy, stored.max_depth, stored.model_version) == (0.5, 2, "v1")


def test_regressors(bars):
    settings = fc.ModelSettings(max_depth=2, n_estimators=2)
    frame = fc.feature_frame(bars)
    for label in ("next_close", "next_range"):
        model = fc.train_regressor(frame, label, settings)
        scored = model.transform(frame.dropna(subset=[*settings.features, label]))
        (row,) = fc.regression_metrics(scored, label).collect()
        assert row.n > 0 and row.rmse >= row.mae >= 0


def _forecasts(spark, pairs):
    data = [("A", START + timedelta(days=i), p, c) for i, (p, c) in enumerate(pairs)]
    both = spark.createDataFrame(
        data, "symbol STRING, fetch_date DATE, predicted_direction INT, close_price DOUBLE"
    )
    predictions = both.filter("predicted_direction is not null").select(
        "symbol", F.col("fetch_date").alias("prediction_date"), "predicted_direction",
        F.lit(0.6).alias("probability"),
    )
    return predictions, both.select("symbol", "fetch_date", "close_price")


def test_lag_before_or_after_the_join(spark):
    predictions, gold = _forecasts(spark, [(1, 10.0), (None, 30.0), (1, 20.0)])
    before = fc.forecast_vs_actual(predictions, gold).orderBy("time").collect()
    after = fc.forecast_vs_actual(predictions, gold, lag_after_join=True).orderBy("time").collect()
    assert [r.actual_direction for r in before] == [0, 0]
    assert [r.actual_direction for r in after] == [0, 1]


def test_streaks_longer_than_three(spark):
    closes = [1.0, 2.0, 3.0, 4.0, 5.0, 4.0, 3.0]
    predictions, gold = _forecasts(spark, [(0, c) for c in closes])
    (streak,) = fc.losing_streaks(fc.forecast_vs_actual(predictions, gold)).collect()
    assert (streak.days_wrong, streak.first_day.day, streak.last_day.day) == (4, 2, 5)


def test_metrics(spark):
    compared = spark.createDataFrame(
        [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "predicted_direction INT, actual_direction INT"
    )
    (m,) = fc.direction_metrics(compared).collect()
    assert (m.n, m.accuracy) == (5, 0.6)
    assert (m.precision, m.recall, m.f1_score) == (pytest.approx(2 / 3),) * 3
    empty = fc.direction_metrics(compared.limit(0)).first()
    assert (empty.n, empty.accuracy) == (0, None)


def test_panel_ranges_and_limits(spark):
    gold = spark.createDataFrame(
        [("B", START, 1.0, 0), ("A", START, 2.0, 100), ("A", START + timedelta(days=1), 3.0, 10)],
        "symbol STRING, fetch_date DATE, close_price DOUBLE, volume BIGINT",
    )
    got = panels.volume_panel(gold, end="2024-01-01").collect()
    assert [(r.symbol, r.Volume, r.log10_volume) for r in got] == [("A", 100, 2.0), ("B", 0, None)]
    assert panels.price_panel(gold, start="2024-01-02").count() == 1
    assert panels.preview(gold, 2, ["fetch_date", "symbol"]).count() == 2


def test_only_what_models_read_is_written(spark):
    from barlake.plans import predictions

    bars = spark.sql(
        "SELECT 'A' AS symbol, date_add(DATE '2024-01-01', cast(id AS int)) AS fetch_date, 1.0D * id + 1 AS close_price,"
        " id AS volume, 0.0D AS daily_return, 0.0D AS price_range FROM range(30)"
    )
    frame = predictions.split_features(bars)
    assert set(frame.columns) == {"symbol", "fetch_date", *fc.FEATURES, *predictions.LABELS, "split"}
