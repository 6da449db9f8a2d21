"""Train, score and store next-day predictions (L-3, L-5, L-7, M12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.operators import forecasting as fc
from barlake.operators.upsert import merge_upsert
from barlake.sources.dimensions import generate_dim_date
from barlake.storage import scratch_path

PREDICTION_KEYS = ["symbol", "prediction_date"]
PREDICTION_PARTITIONS = ["month_key"]
STORED_DDL = f"{schemas.PREDICTIONS_DDL}, month_key INT"


LABELS = ["target", "next_close", "next_range"]


def split_features(bars: DataFrame, settings: fc.ModelSettings | None = None) -> DataFrame:
    """Features with their split. Written once: the cut date and training read them many times.

    Only what models read is computed and written; the frame's other windows are left out.
    """
    spark = bars.sparkSession
    settings = settings or fc.ModelSettings()
    frame = fc.feature_frame(bars)
    needed = {"symbol", "fetch_date", *settings.features, *LABELS}
    path = scratch_path(spark, "features")
    frame.select(*[c for c in frame.columns if c in needed]).write.parquet(path)
    return fc.with_split(spark.read.parquet(path))


def store_predictions(spark: SparkSession, path: str, predictions: DataFrame) -> None:
    """Upsert on symbol and date; predicting a day again replaces its row."""
    month = F.date_format("prediction_date", "yyyyMM").cast("int")
    merge_upsert(
        spark,
        path,
        predictions.withColumn("month_key", month),
        PREDICTION_KEYS,
        PREDICTION_PARTITIONS,
        STORED_DDL,
    )


def test_metrics(model, frame: DataFrame, settings: fc.ModelSettings) -> DataFrame:
    """A-10 on the test dates: one row."""
    test = frame.filter("split = 'test'").dropna(subset=[*settings.features, "target"])
    scored = model.transform(test).select(
        F.col("prediction").cast("int").alias("predicted_direction"),
        F.col("target").alias("actual_direction"),
    )
    return fc.direction_metrics(scored)


def train_version(
    frame: DataFrame, root: str, version: str, settings: fc.ModelSettings | None = None
) -> None:
    """Train on the training dates and store the model with its test metrics."""
    settings = settings or fc.ModelSettings()
    model = fc.train_direction(frame.filter("split = 'train'"), settings)
    fc.save_model(model, root, version, settings, test_metrics(model, frame, settings))


def predict_newest(
    spark: SparkSession,
    bars: DataFrame,
    models: str,
    version: str,
    path: str,
    settings: fc.ModelSettings | None = None,
) -> None:
    """Train a version on stored bars and predict the day after each symbol's newest bar."""
    settings = settings or fc.ModelSettings()
    frame = split_features(bars, settings)
    train_version(frame, models, version, settings)
    newest = fc.predict_direction(
        fc.load_model(models, version),
        fc.latest_rows(frame),
        generate_dim_date(spark),
        version,
        settings,
    )
    store_predictions(spark, path, newest)
