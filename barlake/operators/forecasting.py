"""Model features, MLlib models and forecast checks (L-1..L-8, J-7, W-8, W-13, W-14, A-10)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators import boosting
from barlake.operators import indicators as ind
from barlake.operators.bars import symbol_window

LAG_COLUMNS = {"close_price": "close", "volume": "volume", "daily_return": "return"}

FEATURES = [
    "close_price",
    "sma_5",
    "sma_10",
    "sma_20",
    "close_lag_1",
    "volume_lag_1",
    "return_lag_1",
    "return_1",
    "return_4",
    "price_sma_20_ratio",
    "rsi_14",
]


def feature_frame(
    bars: DataFrame, lags: tuple[int, ...] = (1,), steps: tuple[int, ...] = (1, 4, 24)
) -> DataFrame:
    """L-1: W-6, W-7, W-8, W-10 and W-11 over bars with returns.

    Every window has the same partitioning and order: one shuffle, one sort. The averages share the past closes.
    """
    frame = ind.with_moving_averages(ind.with_past_closes(bars, 19))
    frame = ind.with_lags(frame, LAG_COLUMNS, lags)
    frame = ind.with_volatility(ind.with_step_returns(frame, steps))
    frame = ind.with_rsi(ind.with_price_ratios(frame))
    return with_targets(ind.without_past_closes(frame))


def with_targets(bars: DataFrame) -> DataFrame:
    """W-8, L-8, L-4: next close, its direction, and next day's range.

    Null on the last bar of a symbol, which can be predicted but not learnt from.
    """
    next_close = F.lead("close_price", 1).over(symbol_window())
    frame = bars.withColumn("next_close", next_close)
    if "price_range" in bars.columns:
        frame = frame.withColumn("next_range", F.lead("price_range", 1).over(symbol_window()))
    return frame.withColumn(
        "target",
        F.when(
            F.col("next_close").isNotNull(),
            (F.col("next_close") > F.col("close_price")).cast("int"),
        ),
    )


def cut_date(frame: DataFrame, share: float = 0.8) -> DataFrame:
    """L-2: the date, as one row, that ends the first ``share`` of distinct dates."""
    dates = frame.select("fetch_date").distinct()
    return dates.selectExpr(
        f"date_from_unix_date(cast(percentile_disc({share}) within group"
        " (order by unix_date(fetch_date)) as int)) as cut"
    )


def with_split(frame: DataFrame, share: float = 0.8) -> DataFrame:
    """L-2: chronological split, never random.

    The cut date enters the plan as a scalar subquery.
    """
    is_train = F.col("fetch_date") <= cut_date(frame, share).scalar()
    return frame.withColumn("split", F.when(is_train, "train").otherwise("test"))


@dataclass(frozen=True)
class ModelSettings:
    """Boosting parameters, under the names the training log uses."""

    max_depth: int = 3
    n_estimators: int = 20
    learning_rate: float = 0.1
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    seed: int = 42


def _fit(settings: ModelSettings, estimator, rows: DataFrame) -> PipelineModel:
    """The pipeline that MLlib would fit, whose trees are grown over stored bins."""
    assembler = VectorAssembler(inputCols=settings.features, outputCol="features")
    return PipelineModel([assembler, boosting.fit_boosted(estimator, rows, settings.features)])


def _complete(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.dropna(subset=columns)


def train_direction(train: DataFrame, settings: ModelSettings) -> PipelineModel:
    """L-3: will the next close be higher?"""
    rows = _complete(train, [*settings.features, "target"])
    estimator = GBTClassifier(
        labelCol="target",
        maxDepth=settings.max_depth,
        maxIter=settings.n_estimators,
        stepSize=settings.learning_rate,
        seed=settings.seed,
    )
    return _fit(settings, estimator, rows)


def train_regressor(train: DataFrame, label: str, settings: ModelSettings) -> PipelineModel:
    """L-4 with ``next_range``, L-8 with ``next_close``."""
    rows = _complete(train, [*settings.features, label])
    estimator = GBTRegressor(
        labelCol=label,
        maxDepth=settings.max_depth,
        maxIter=settings.n_estimators,
        stepSize=settings.learning_rate,
        seed=settings.seed,
    )
    return _fit(settings, estimator, rows)


def next_days(dim_date: DataFrame) -> DataFrame:
    """Each calendar day with the one after it; bounded by the dimension."""
    days = dim_date.select(F.to_date("full_date").alias("fetch_date"))
    return days.withColumn("prediction_date", F.date_add("fetch_date", 1)).join(
        days.select(F.col("fetch_date").alias("prediction_date")), "prediction_date", "left_semi"
    )


def predict_direction(
    model: PipelineModel,
    frame: DataFrame,
    dim_date: DataFrame,
    version: str,
    settings: ModelSettings,
    created_at=None,
) -> DataFrame:
    """L-5: rows for ``daily_predictions``, one per symbol and day with full features."""
    scored = model.transform(_complete(frame, settings.features))
    up = vector_to_array("probability")[1]
    direction = F.col("prediction").cast("int")
    created = F.current_timestamp() if created_at is None else F.lit(created_at)
    return scored.join(F.broadcast(next_days(dim_date)), "fetch_date", "inner").select(
        "symbol",
        "prediction_date",
        direction.alias("predicted_direction"),
        F.when(direction == 1, up).otherwise(1 - up).alias("probability"),
        F.lit(version).alias("model_version"),
        created.cast("timestamp").alias("created_at"),
    )


def latest_rows(frame: DataFrame) -> DataFrame:
    """The newest bar of each symbol, for today's prediction."""
    newest = Window.partitionBy("symbol")
    return (
        frame.withColumn("_newest", F.max("fetch_date").over(newest))
        .filter(F.col("fetch_date") == F.col("_newest"))
        .drop("_newest")
    )


def forecast_vs_actual(
    predictions: DataFrame, gold: DataFrame, lag_after_join: bool = False
) -> DataFrame:
    """J-7, W-13: predicted and actual direction.

    The actual direction compares with the symbol's previous bar. With
    ``lag_after_join`` it compares with the previous day that also has a
    prediction, as the documented panel does.
    """
    previous = F.lag("close_price", 1).over(symbol_window())
    actual = F.when(F.col("close_price") > F.col("previous_close"), 1).otherwise(0)
    bars = gold.select("symbol", "fetch_date", "close_price")
    if not lag_after_join:
        bars = bars.withColumn("previous_close", previous)
    joined = predictions.withColumnRenamed("prediction_date", "fetch_date").join(
        bars, ["symbol", "fetch_date"], "inner"
    )
    if lag_after_join:
        joined = joined.withColumn("previous_close", previous)
    # The column names of the panel.
    return joined.select(
        F.col("fetch_date").cast("timestamp_ntz").alias("time"),
        "symbol",
        "predicted_direction",
        "probability",
        F.col("close_price").alias("actual_close"),
        actual.alias("actual_direction"),
    )


def losing_streaks(compared: DataFrame, longer_than: int = 3) -> DataFrame:
    """W-14: runs of wrong forecasts, per symbol."""
    by_time = Window.partitionBy("symbol").orderBy("time")
    wrong = F.col("predicted_direction") != F.col("actual_direction")
    within = Window.partitionBy("symbol", "wrong").orderBy("time")
    islands = compared.withColumn("wrong", wrong).withColumn(
        "island", F.row_number().over(by_time) - F.row_number().over(within)
    )
    return (
        islands.filter("wrong")
        .groupBy("symbol", "island")
        .agg(
            F.min("time").alias("first_day"),
            F.max("time").alias("last_day"),
            F.count(F.lit(1)).alias("days_wrong"),
        )
        .filter(F.col("days_wrong") > longer_than)
        .drop("island")
    )


def direction_metrics(compared: DataFrame) -> DataFrame:
    """A-10: accuracy, precision, recall and F1, as one row."""
    predicted, actual = F.col("predicted_direction"), F.col("actual_direction")
    counts = compared.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((predicted == 1) & (actual == 1)).alias("tp"),
        F.count_if((predicted == 1) & (actual == 0)).alias("fp"),
        F.count_if((predicted == 0) & (actual == 1)).alias("fn"),
        F.count_if(predicted == actual).alias("hits"),
    )
    return counts.select(
        "n",
        F.try_divide("hits", "n").alias("accuracy"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias(
            "f1_score"
        ),
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """A-10: RMSE and MAE, as one row."""
    error = F.col(prediction) - F.col(label)
    return scored.agg(
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def save_model(
    model: PipelineModel, root: str, version: str, settings: ModelSettings, metrics: DataFrame
) -> None:
    """L-7: the model under its version, and one row of parameters and metrics.

    An existing version is not overwritten.
    """
    place = f"{root.rstrip('/')}/{version}"
    model.write().save(f"{place}/model")
    metrics.withColumns(
        {
            "model_version": F.lit(version),
            "max_depth": F.lit(settings.max_depth),
            "n_estimators": F.lit(settings.n_estimators),
            "learning_rate": F.lit(settings.learning_rate),
        }
    ).write.json(f"{place}/metrics")


def load_model(root: str, version: str) -> PipelineModel:
    """L-7"""
    return PipelineModel.load(f"{root.rstrip('/')}/{version}/model")
