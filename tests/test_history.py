import pytest
from helpers import rows
from pyspark.sql import functions as F

from barlake.operators import history as hist
from barlake.storage import path_exists

DDL = "k INT, v STRING"


def build(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], DDL)
    second = spark.createDataFrame([(2, "B"), (3, "c")], DDL)
    history = hist.start_history(first, 1)
    return hist.apply_version(history, second, ["k"], 2), second


def test_as_of_every_version(spark):
    history, _ = build(spark)
    assert rows(hist.as_of(history, 0)) == []
    assert rows(hist.as_of(history, 1)) == [(1, "a"), (2, "b")]
    assert rows(hist.as_of(history, 2)) == [(1, "a"), (2, "B"), (3, "c")]


def test_applying_twice_changes_nothing(spark):
    history, second = build(spark)
    again = hist.apply_version(history, second, ["k"], 2)
    assert rows(again, "k", "valid_from") == rows(history, "k", "valid_from")


def test_full_snapshot_closes_missing_rows(spark):
    history, _ = build(spark)
    third = spark.createDataFrame([(3, "c")], DDL)
    after = hist.apply_version(history, third, ["k"], 3, delete_missing=True)
    assert rows(hist.as_of(after, 3)) == [(3, "c")]
    assert rows(hist.as_of(after, 2)) == [(1, "a"), (2, "B"), (3, "c")]


def test_null_values_compare_equal(spark):
    history = hist.start_history(spark.createDataFrame([(1, None)], DDL), 1)
    after = hist.apply_version(history, spark.createDataFrame([(1, None)], DDL), ["k"], 2)
    assert after.count() == 1


def test_versions_and_expiry(spark):
    history, _ = build(spark)
    assert rows(hist.versions(history)) == [(1, 2, 0), (2, 2, 1)]
    assert hist.expire_versions(history, retain_last=2).count() == history.count()
    kept = hist.expire_versions(history, retain_last=1)
    assert rows(hist.as_of(kept, 2)) == rows(hist.as_of(history, 2))
    assert kept.count() == 3


def test_layouts_and_dropped_columns(spark):
    old = spark.createDataFrame([(1, "a")], DDL)
    new = spark.createDataFrame([(2, "b", "x")], f"{DDL}, extra STRING")
    both = hist.union_layouts(old, new)
    assert rows(both, "k") == [(1, "a", None), (2, "b", "x")]
    assert hist.drop_columns(both, "extra").columns == ["k", "v"]


def test_stored_history_equals_the_expression(spark, folder):
    ddl = f"{DDL}, p INT, valid_from BIGINT, valid_to BIGINT"
    path = f"{folder}/history"
    batches = [
        [(1, "a", 1), (2, "b", 1), (3, "c", 2)],
        [(2, "B", 1), (4, "d", 2)],
        [(2, "B", 1), (1, "A", 1)],
    ]
    expected = None
    for version, data in enumerate(batches, start=1):
        batch = spark.createDataFrame(data, f"{DDL}, p INT")
        for _ in range(2):
            hist.store_version(spark, path, batch, ["k"], version, ["p"], ddl)
        expected = (
            hist.start_history(batch, 1)
            if expected is None
            else hist.apply_version(expected, batch, ["k"], version)
        )
    stored = spark.read.schema(ddl).parquet(path).select(*expected.columns)
    assert rows(stored, "k", "valid_from") == rows(expected, "k", "valid_from")


OLD_DDL, NEW_DDL = "k INT, v STRING, month INT", "k INT, v STRING, extra STRING, year INT"


def layouts(spark, folder):
    old, new = f"{folder}/old", f"{folder}/new"
    spark.createDataFrame([(1, "a", 202311), (2, "b", 202402)], OLD_DDL).write.partitionBy("month").parquet(old)
    spark.createDataFrame([(3, "c", "x", 2024), (4, "d", "y", 2025)], NEW_DDL).write.partitionBy("year").parquet(new)
    return old, new


def rewrite(spark, old, new):
    year = F.floor(F.col("month") / 100)
    return hist.rewrite_layout(
        spark, old, new, ["year"], OLD_DDL, NEW_DDL, lambda rows: rows.withColumn("year", year).drop("month")
    )


WHOLE = [(1, "a", None, 2023), (2, "b", None, 2024), (3, "c", "x", 2024), (4, "d", "y", 2025)]


def test_layout_is_rewritten_once(spark, folder):
    old, new = layouts(spark, folder)
    assert [rewrite(spark, old, new), rewrite(spark, old, new)] == [True, False]
    assert rows(spark.read.schema(NEW_DDL).parquet(new), "k") == WHOLE
    assert not path_exists(spark, old) and not path_exists(spark, f"{new}__layout")


@pytest.mark.parametrize("broken", ["rename", "replace_partitions", "remove_tree", "discard_staging"])
def test_next_run_completes_a_rewrite(spark, folder, monkeypatch, broken):
    old, new = layouts(spark, folder)

    def die(*args):
        raise OSError("driver lost")

    # The first call of all, to discard what an earlier run left, must go through.
    calls, real = [], getattr(hist, broken)
    allowed = 1 if broken == "discard_staging" else 0
    with monkeypatch.context() as patched:
        patched.setattr(hist, broken, lambda *a: real(*a) if calls.append(a) or len(calls) <= allowed else die())
        with pytest.raises(OSError):
            rewrite(spark, old, new)
    rewrite(spark, old, new)
    rewrite(spark, old, new)
    assert rows(spark.read.schema(NEW_DDL).parquet(new), "k") == WHOLE
    assert not path_exists(spark, old)


def test_old_folder_alone_and_none(spark, folder):
    old, new = layouts(spark, folder)
    assert rewrite(spark, old, f"{folder}/fresh")
    assert rows(spark.read.schema(NEW_DDL).parquet(f"{folder}/fresh"), "k") == WHOLE[:2]
    assert not rewrite(spark, f"{folder}/none", new)


def test_a_stored_batch_is_computed_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    ddl = "k INT, v INT, valid_from BIGINT, valid_to BIGINT, part INT"

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    for version in (1, 2):
        rows = spark.createDataFrame([(i, i * version, i % 2) for i in range(10)], "k int, v int, part int")
        hist.store_version(
            spark, f"{folder}/h", rows.mapInPandas(counted, rows.schema), ["k"], version, ["part"], ddl
        )
    assert seen.value == 20
    assert sorted(r.v for r in hist.as_of(spark.read.schema(ddl).parquet(f"{folder}/h"), 2).collect()) == list(range(0, 20, 2))
