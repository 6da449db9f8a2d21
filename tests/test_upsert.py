import shutil
from pathlib import Path

import pytest
from helpers import rows

from barlake.operators import upsert
from barlake.storage import path_exists

DDL = "k INT, v STRING, p INT"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def load(spark, path, data):
    upsert.merge_upsert(spark, path, frame(spark, data), ["k"], ["p"], DDL)


def stored(spark, path):
    return rows(spark.read.schema(DDL).parquet(path), "k")


def test_insert_update_and_repeat(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1), (2, "b", 1), (3, "c", 2)])
    for _ in range(2):
        load(spark, path, [(2, "B", 1), (4, "d", 3)])
        assert stored(spark, path) == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 3)]


def test_untouched_partitions_keep_their_files(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1), (3, "c", 2)])
    before = set(spark.read.parquet(f"{path}/p=2").inputFiles())
    load(spark, path, [(1, "A", 1)])
    assert set(spark.read.parquet(f"{path}/p=2").inputFiles()) == before


def test_empty_source_changes_nothing(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1)])
    load(spark, path, [])
    assert stored(spark, path) == [(1, "a", 1)]


def test_duplicate_source_keys_are_refused(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1)])
    with pytest.raises(upsert.DuplicateKeyError):
        load(spark, path, [(2, "x", 1), (2, "y", 1)])
    assert stored(spark, path) == [(1, "a", 1)]
    load(spark, path, [(2, "x", 1)])
    assert stored(spark, path) == [(1, "a", 1), (2, "x", 1)]


def test_a_merge_that_died_while_publishing_is_completed(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1), (2, "b", 2)])
    frame(spark, [(1, "A", 1)]).write.parquet(upsert.staged_path(path))
    load(spark, path, [(3, "c", 2)])
    assert stored(spark, path) == [(1, "A", 1), (2, "b", 2), (3, "c", 2)]
    assert not path_exists(spark, f"{path}__staging")


def test_a_merge_that_died_while_staging_is_forgotten(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1)])
    (spark.range(1).write.parquet(f"{path}__staging/source-x"))
    assert upsert.complete_pending(spark, path, ["p"]) is False
    assert stored(spark, path) == [(1, "a", 1)]


def test_columns_missing_in_the_source_keep_their_values(spark):
    target = spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "k INT, v STRING, extra INT")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k INT, v STRING")
    assert rows(upsert.merge_rows(target, source, ["k"])) == [
        (1, "a", 7),
        (2, "B", 8),
        (3, "C", None),
    ]


def test_change_events(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    changes = spark.createDataFrame(
        [(1, "x", 1, "u"), (1, "y", 2, "u"), (2, None, 5, "d"), (4, "n", 1, "c"), (2, "q", 4, "u")],
        "k INT, v STRING, version INT, op STRING",
    )
    assert rows(upsert.apply_changes(target, changes, ["k"])) == [(1, "y"), (3, "c"), (4, "n")]


def test_target_is_pruned_to_touched_partitions(spark, folder):
    path = f"{folder}/t"
    load(spark, path, [(i, "a", i) for i in range(5)])
    table = spark.read.schema(DDL).parquet(path)
    pruned = upsert.touched_rows(table, frame(spark, [(9, "x", 3)]), ["p"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan or "(p#" in plan.split("PartitionFilters")[1]
    assert rows(pruned) == [(3, "a", 3)]


@pytest.mark.parametrize("literals", [0, 2000])
def test_null_partitions_are_kept_whatever_finds_them(spark, folder, monkeypatch, literals):
    monkeypatch.setattr(upsert, "MAX_LITERAL_PARTITIONS", literals)
    path, ddl = f"{folder}/t", "k STRING, v INT, p STRING"

    def load(*data):
        upsert.merge_upsert(spark, path, spark.createDataFrame(list(data), ddl), ["k"], ["p"], ddl)

    load(("a", 1, None), ("b", 1, "x"))
    load(("c", 2, None))
    load(("a", 3, None), ("d", 3, "y"))
    stored = spark.read.schema(ddl).parquet(path).collect()
    assert sorted((r.k, r.v, r.p) for r in stored) == [
        ("a", 3, None), ("b", 1, "x"), ("c", 2, None), ("d", 3, "y"),
    ]
    two = "k STRING, v INT, p STRING, q INT"
    target = spark.createDataFrame([("a", 1, None, 1), ("b", 1, "x", None), ("c", 1, "x", 1)], two)
    source = spark.createDataFrame([("z", 1, None, 1), ("y", 1, "x", None)], two)
    assert {r.k for r in upsert.touched_rows(target, source, ["p", "q"]).collect()} == {"a", "b"}


def test_merge_statement_and_who_takes_it(spark):
    statement = upsert.merge_statement("db.t", "src", ["symbol", "a`b"], ["symbol", "a`b", "volume"], ("month_key",))
    assert statement == (
        "MERGE INTO db.t t USING src s ON t.`symbol` <=> s.`symbol` AND t.`a``b` <=> s.`a``b`"
        " AND t.`month_key` <=> s.`month_key` WHEN MATCHED THEN UPDATE SET t.`volume` = s.`volume`"
        " WHEN NOT MATCHED THEN INSERT (`symbol`, `a``b`, `volume`) VALUES (s.`symbol`, s.`a``b`, s.`volume`)"
    )
    spark.sql("CREATE TABLE IF NOT EXISTS plain_rows (symbol STRING) USING parquet")
    try:
        assert not upsert.supports_merge(spark, "plain_rows")
        with pytest.raises(ValueError, match="merge_upsert"):
            upsert.merge_table(spark, "plain_rows", spark.table("plain_rows"), ["symbol"])
    finally:
        spark.sql("DROP TABLE plain_rows")


def test_changes_of_a_null_key(spark):
    target = spark.createDataFrame([(None, 1), ("A", 2)], "symbol string, volume int")
    changes = spark.createDataFrame([(None, 9, 1, "u"), ("A", 0, 1, "d")], "symbol string, volume int, version int, op string")
    assert upsert.apply_changes(target, changes, ["symbol"]).collect() == [(None, 9)]


def test_a_merge_that_died_between_two_partitions_is_completed(spark, folder, monkeypatch):
    path = f"{folder}/t"
    load(spark, path, [(1, "a", 1), (2, "b", 2), (3, "c", None)])
    real, calls = upsert.move_partitions, []

    def die_after_one(spark_, source, target, depth):
        # The second folder stays in the staging area.
        calls.append(real(spark_, source, target, depth) if calls else None)
        if len(calls) == 1:
            fs_source = next(p for p in sorted(Path(source).iterdir()) if "=" in p.name)
            place = Path(target) / fs_source.name
            shutil.rmtree(place)
            fs_source.rename(place)
            raise OSError("driver lost")
        return calls[-1]

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "move_partitions", die_after_one)
        with pytest.raises(OSError):
            load(spark, path, [(1, "A", 1), (2, "B", 2), (4, "D", None)])
        load(spark, path, [(5, "e", 1)])
    assert stored(spark, path) == [(1, "A", 1), (2, "B", 2), (3, "c", None), (4, "D", None), (5, "e", 1)]
