import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from barlake.operators import boosting

FEATURES = ["a", "b", "c", "same", "few"]


def table(spark, count):
    return spark.range(count, numPartitions=3).selectExpr(
        "id",
        "(id * 7919) % 1009 / 10.0D AS a",
        "(id * 104729) % 97 AS b",
        "CASE WHEN id % 5 = 0 THEN 0D ELSE (id * 31) % 503 - 200D END AS c",
        "1.0D AS same",
        "(id * 17) % 3 AS few",
    ).selectExpr(
        "*",
        "sin(a / 9) * 10 + b / 10 + c * c / 5000 + (id * 613) % 37 / 10.0D AS size",
        "cast(a + b + (id * 613) % 37 > 90 AS int) AS up",
    )


def estimator(kind, label, **more):
    return kind(labelCol=label, maxDepth=3, maxIter=6, stepSize=0.1, seed=42, **more)


def nodes(model):
    """Shape of the trees, splits with thresholds, and predictions, as words of the printed model."""
    return model.toDebugString.split("\n", 1)[1].split()


def same_models(ours, theirs):
    left, right = nodes(ours), nodes(theirs)
    assert len(left) == len(right)
    for a, b in zip(left, right, strict=True):
        try:
            a, b = float(a.strip("()")), float(b.strip("()"))
        except ValueError:
            assert a == b
        else:
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("kind, label", [(GBTRegressor, "size"), (GBTClassifier, "up")])
def test_the_model_is_the_one_of_mllib(spark, monkeypatch, kind, label):
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 300)
    rows = table(spark, 2000)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    theirs = estimator(kind, label).fit(assembler.transform(rows))
    ours = boosting.fit_boosted(estimator(kind, label), rows, FEATURES)
    assert type(ours) is type(theirs) and ours.treeWeights == theirs.treeWeights
    same_models(ours, theirs)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


def test_mllib_fits_nothing_itself(spark, monkeypatch):
    from barlake.operators import forecasting as fc

    def fit(*_):
        raise AssertionError("rows went through MLlib's trees")

    monkeypatch.setattr(GBTRegressor, "_fit", fit)
    monkeypatch.setattr(GBTClassifier, "_fit", fit)
    settings = fc.ModelSettings(max_depth=2, n_estimators=2, features=FEATURES)
    rows = table(spark, 200).withColumn("target", F.col("up"))
    for model in (fc.train_direction(rows, settings), fc.train_regressor(rows, "size", settings)):
        assert model.stages[1].getNumTrees == 2
        assert model.transform(rows).filter("prediction IS NOT NULL").count() == 200


def test_every_row_counts_over_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(boosting, "EXACT_ROWS", 500)
    rows = table(spark, 6000)
    model = boosting.fit_boosted(estimator(GBTRegressor, "size"), rows, FEATURES)
    root = model._java_obj.getTree(0).rootNode()
    assert root.impurityStats().rawCount() == 6000
    (mean,) = rows.agg(F.avg("size")).first()
    assert root.prediction() == pytest.approx(mean)


def test_ranks_of_all_rows_give_even_bins(spark, monkeypatch):
    monkeypatch.setattr(boosting, "EXACT_ROWS", 500)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 700)
    rows = spark.range(9000, numPartitions=4).selectExpr("cast(id * id AS double) AS x", "1D AS y")
    bins = boosting.find_bins(rows, ["x", "y"])
    assert bins.count(0) == 32 and bins.count(1) == 1
    sizes = np.diff([0, *np.searchsorted(np.arange(9000.0) ** 2, bins.thresholds[0]), 9000])
    assert (abs(sizes - 9000 / 32) < 9000 / 32 / 4).all()


def test_labels_without_spread_give_single_leaves(spark):
    rows = table(spark, 50).withColumn("flat", F.lit(3.0))
    ours = boosting.fit_boosted(estimator(GBTRegressor, "flat"), rows, FEATURES)
    theirs = estimator(GBTRegressor, "flat").fit(
        VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    )
    same_models(ours, theirs)


def test_bad_input_is_refused(spark):
    with pytest.raises(ValueError, match="no complete rows"):
        boosting.fit_boosted(estimator(GBTRegressor, "size"), table(spark, 0), FEATURES)
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.fit_boosted(estimator(GBTClassifier, "few"), table(spark, 50), FEATURES)


def test_batch_setting_is_restored(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    boosting.fit_boosted(estimator(GBTRegressor, "size"), table(spark, 50), FEATURES)
    assert spark.conf.get(name) == before
