import pytest
from pyspark.sql import functions as F

from barlake.functions.ordering import SEQ_BITS, by_offset, by_seq, pack_order_key


def test_small_keys_are_longs_and_large_ones_decimals(spark):
    df = spark.range(1)
    small = df.select(pack_order_key((F.col("id"), 8), (F.col("id"), 10)).alias("k"))
    large = df.select(pack_order_key((F.col("id"), 8), (F.col("id"), 18)).alias("k"))
    assert small.schema["k"].dataType.simpleString() == "bigint"
    assert large.schema["k"].dataType.simpleString() == "decimal(38,0)"


def test_too_many_digits_are_refused(spark):
    with pytest.raises(ValueError):
        pack_order_key((F.lit(1), 18), (F.lit(1), 18), (F.lit(1), 3))
    with pytest.raises(ValueError):
        pack_order_key((F.lit(1), 19))


@pytest.mark.parametrize("value", [-1, 1000, None])
def test_values_that_do_not_fit_are_errors(spark, value):
    df = spark.createDataFrame([(value,)], "v BIGINT")
    with pytest.raises(Exception, match="order key part"):
        df.select(pack_order_key((F.col("v"), 3))).collect()


def test_packed_order_equals_column_order(spark):
    last = 10**18 - 1
    pairs = [(a, b) for a in (0, 5, 99_999_999) for b in (0, 1, 7, last)]
    df = spark.createDataFrame(pairs, "a BIGINT, b BIGINT")
    key = pack_order_key((F.col("a"), 8), (F.col("b"), 18))
    assert [tuple(r) for r in df.orderBy(key).collect()] == sorted(pairs)


MESSAGE_DDL = "trade_time BIGINT, topic STRING, partition INT, offset BIGINT"


def full_order(df, order):
    keyed = df.withColumn("k", order.key).select("*", *order.source_columns())
    return [tuple(r)[: len(df.columns)] for r in keyed.orderBy(order.widen("k")).collect()]


def test_offset_order_is_time_topic_partition_offset(spark):
    high = 5 << SEQ_BITS
    data = [(0, "b", 1, 5), (0, "a", 2, 9), (0, "a", 2, high), (0, "a", 0, high + 1), (1, "a", 0, 0)]
    df = spark.createDataFrame(data, MESSAGE_DDL)
    assert full_order(df, by_offset(["b", "a"])) == sorted(data)


def test_seq_order_holds_for_the_largest_numbers(spark):
    top = 2**63 - 1
    data = [(t, s) for t in (0, 86_399_999) for s in (0, 1, 1 << SEQ_BITS, top - 1, top)]
    df = spark.createDataFrame(data, "trade_time BIGINT, seq BIGINT")
    assert full_order(df, by_seq()) == sorted(data)


@pytest.mark.parametrize("message", [(0, "x", 0, 0), (0, "a", 0, -1), (0, "a", -1, 0)])
def test_messages_that_cannot_be_ordered_are_errors(spark, message):
    df = spark.createDataFrame([message], MESSAGE_DDL)
    with pytest.raises(Exception, match="order key part"):
        full_order(df, by_offset(["a"]))
