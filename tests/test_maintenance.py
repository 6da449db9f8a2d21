from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from barlake.operators import maintenance as maint
from barlake.sources import tables

DDL = "id BIGINT, p INT"


def small_files(spark, path):
    spark.range(200).withColumn("p", (F.col("id") % 2).cast("int")).repartition(6).write.partitionBy(
        "p"
    ).parquet(path)
    spark.range(200, 201).withColumn("p", F.lit(7)).write.partitionBy("p").parquet(f"{path}_x")


def test_compaction_keeps_rows_and_fine_partitions(spark, folder):
    path = f"{folder}/t"
    small_files(spark, path)
    spark.range(3).coalesce(1).withColumn("p", F.lit(9)).write.mode("append").partitionBy(
        "p"
    ).parquet(path)
    table = spark.read.schema(DDL).parquet(path)
    expected = rows(table)
    fine = {f for f in table.inputFiles() if "p=9" in f}
    assert maint.compact(spark, path, ["p"], DDL) == (13, 3)
    after = spark.read.schema(DDL).parquet(path)
    assert rows(after) == expected
    assert {f for f in after.inputFiles() if "p=9" in f} == fine
    assert maint.compact(spark, path, ["p"], DDL) == (3, 3)


def test_compaction_takes_null_partitions_and_leaves_others_alone(spark, folder):
    path = f"{folder}/t"
    data = spark.range(300).withColumn("p", F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("int")))
    data.repartition(5).write.partitionBy("p").parquet(path)
    expected = rows(spark.read.schema(DDL).parquet(path))
    assert maint.compact(spark, path, ["p"], DDL, only=~F.col("p").eqNullSafe(2)) == (15, 7)
    assert rows(spark.read.schema(DDL).parquet(path)) == expected
    assert maint.compact(spark, path, ["p"], DDL) == (7, 3)
    assert rows(spark.read.schema(DDL).parquet(path)) == expected


def test_compaction_converges(spark, folder):
    path = f"{folder}/t"
    data = spark.range(20_000).withColumn("p", F.lit(1)).withColumn("id", F.xxhash64("id"))
    data.repartition(30).write.partitionBy("p").parquet(path)
    before, after = maint.compact(spark, path, ["p"], DDL, target_bytes=50_000)
    assert before == 30 and after <= 6
    assert maint.compact(spark, path, ["p"], DDL, target_bytes=50_000) == (after, after)
    assert spark.read.schema(DDL).parquet(path).distinct().count() == 20_000


def test_orphans_are_reported_whatever_the_partition_is_called(spark, folder):
    path = f"{folder}/t"
    names = spark.range(8).withColumn("p", F.when(F.col("id") % 2 == 0, "a b+c%").otherwise("x"))
    names.write.partitionBy("p").parquet(path)
    maint.committed_files(spark.read.parquet(path)).write.parquet(f"{folder}/manifest")
    manifest = spark.read.parquet(f"{folder}/manifest")
    assert maint.orphan_files(spark, path, manifest).count() == 0
    spark.range(1).coalesce(1).write.mode("append").parquet(f"{path}/p=x")
    assert maint.orphan_files(spark, path, manifest).count() == 1
    assert maint.orphan_files(spark, path, manifest, datetime(2000, 1, 1)).count() == 0


def test_content_hash_sees_lost_and_doubled_rows(spark):
    df = spark.range(10)
    assert maint.content_hash(df) == maint.content_hash(df.orderBy(F.desc("id")))
    assert maint.content_hash(df) != maint.content_hash(df.filter("id <> 3"))
    assert maint.content_hash(df) != maint.content_hash(df.unionByName(df))


def test_maintenance_goes_on_past_failures(spark):
    def broken():
        raise RuntimeError("no such table")

    result = maint.maintain(spark, [("a", "compact", broken), ("b", "compact", lambda: (5, 2))])
    assert rows(result) == [
        ("a", "compact", None, None, "RuntimeError: no such table"),
        ("b", "compact", 5, 2, None),
    ]


def test_partition_listing(spark, folder):
    path = f"{folder}/t"
    small_files(spark, path)
    listed = tables.partition_listing(spark.read.schema(DDL).parquet(path), ["p"])
    assert [(r.p, r.row_count, r.file_count) for r in listed.orderBy("p").collect()] == [
        (0, 100, 6),
        (1, 100, 6),
    ]


def test_orphans_of_a_stream_are_found_and_removed(spark, folder):
    path = f"{folder}/bronze + more"
    source = f"{folder}/source"
    spark.createDataFrame([("a b", 1), ("c", 2)], "p string, v int").write.json(source)
    stream = spark.readStream.schema("p string, v int").json(source).writeStream.format("json").partitionBy("p")
    stream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(path).awaitTermination()
    assert maint.sink_orphans(spark, path, "*.json").count() == 0
    spark.createDataFrame([("c", 3)], "p string, v int").write.mode("append").partitionBy("p").json(path)
    orphans = maint.sink_orphans(spark, path, "*.json").collect()
    assert len(orphans) == 1 and "/p=c/" in orphans[0].file_path
    assert maint.sink_orphans(spark, path, "*.json", datetime(2000, 1, 1)).count() == 0
    before, after = maint.remove_orphans(spark, path, "*.json", F.current_timestamp() + F.expr("INTERVAL 1 DAY"))
    assert before - after == 1
    assert spark.read.schema("p string, v int").json(path).count() == 2
    assert maint.sink_orphans(spark, path, "*.json").count() == 0


def test_partitioned_writes_can_do_without_a_sort(spark, folder):
    before = spark.conf.get(maint.OPEN_FILES)
    with maint.unsorted_writes(spark):
        spark.range(20).selectExpr("id", "id % 3 AS part").repartition(2).write.partitionBy("part").parquet(f"{folder}/t")
        assert spark.conf.get(maint.OPEN_FILES) == "16"
    assert spark.conf.get(maint.OPEN_FILES) == before
    assert spark.read.parquet(f"{folder}/t").groupBy("part").count().orderBy("part").collect()[0]["count"] == 7
