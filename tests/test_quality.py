from datetime import datetime

import pytest
from helpers import plan_of, rows, ticks
from pyspark.sql import functions as F

from barlake import schemas
from barlake.operators import bars, quality


def envelopes(spark, values):
    data = [("k", v, "stock_trades", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.ENVELOPE_DDL)


CASES = [
    ('{"symbol":"A","price":1.5,"quantity":2,"trade_time":5}', None),
    ('{"symbol":"A","price":1.5,"trade_time":5}', None),
    ('{"symbol":"A","pri', "unparseable"),
    ("", "unparseable"),
    (None, "unparseable"),
    ("garbage", "unparseable"),
    ('{"symbol":"A","price":"x","quantity":2,"trade_time":5}', "type_mismatch"),
    ('{"price":1.5,"quantity":2,"trade_time":5}', "null_symbol"),
    ('{"symbol":"A","price":1.5,"quantity":2}', "bad_time"),
    ('{"symbol":"A","price":1.5,"quantity":2,"trade_time":-1}', "bad_time"),
    ('{"symbol":"A","price":1.5,"quantity":2,"trade_time":9223372036854775807}', "bad_time"),
    ('{"symbol":"A","quantity":2,"trade_time":5}', "bad_price"),
    ('{"symbol":"A","price":0,"quantity":2,"trade_time":5}', "bad_price"),
    ('{"symbol":"A","price":"NaN","quantity":2,"trade_time":5}', "bad_price"),
    ('{"symbol":"A","price":"Infinity","quantity":2,"trade_time":5}', "bad_price"),
    ('{"symbol":"A","price":1.5,"quantity":-2,"trade_time":5}', "bad_quantity"),
]


def test_reasons(spark):
    classified = quality.classify(envelopes(spark, [v for v, _ in CASES])).orderBy("offset")
    assert [r.reason for r in classified.collect()] == [reason for _, reason in CASES]


def test_split_is_exact_and_keeps_the_message(spark):
    values = [v for v, _ in CASES]
    classified = quality.classify(envelopes(spark, values))
    dead = quality.dead_letters(classified)
    assert quality.valid_ticks(classified).count() + dead.count() == len(CASES)
    assert {r.value for r in dead.collect()} == {v for v, reason in CASES if reason}


def test_keep_latest_is_deterministic_and_combines_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 1), (1, 20.0, 3), (1, 15.0, 2), (2, 5.0, 9)], "k INT, v DOUBLE, t BIGINT"
    )
    latest = quality.keep_latest(df, ["k"], F.col("t"))
    assert rows(latest) == [(1, 20.0, 3), (2, 5.0, 9)]
    plan = plan_of(latest)
    assert "Window" not in plan and "partial_max_by" in plan and "SortAggregate" not in plan


def test_keep_latest_with_strings(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k INT, v STRING, t BIGINT")
    assert rows(quality.keep_latest(df, ["k"], F.col("t"))) == [(1, "new", 2)]


def test_repeated_quotes_count_once(spark):
    df = ticks(spark, [("A", 5.0, 1.0, 0, 0), ("A", 5.0, 1.0, 0, 1), ("A", 5.0, 1.0, 7, 2)])
    (bar,) = bars.daily_ohlcv(quality.drop_repeated_quotes(df)).collect()
    assert bar.volume == 2


def test_gate_passes_and_raises(spark):
    good = bars.daily_ohlcv(ticks(spark, [("A", 5.0, 1.0, 0, 0)]))
    assert quality.gate(quality.bars_report(good)).count() == 9
    with pytest.raises(quality.QualityGateError, match="unique_symbol_fetch_date"):
        quality.gate(quality.bars_report(good.unionByName(good)))
    with pytest.raises(quality.QualityGateError, match="open_in_range"):
        quality.gate(quality.bars_report(good.withColumn("open_price", F.lit(99.0))))


def test_warnings_do_not_close_the_gate(spark):
    lower = bars.daily_ohlcv(ticks(spark, [("a", 5.0, 1.0, 0, 0)]))
    report = quality.gate(quality.bars_report(lower))
    assert report.filter("check_name = 'symbol_format'").first().failed == 1


def test_timeliness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "ts TIMESTAMP")
    late = quality.timeliness_report(df, "ts", datetime(2024, 1, 1, 0, 5), 120).first()
    fresh = quality.timeliness_report(df, "ts", datetime(2024, 1, 1, 0, 1), 120).first()
    empty = quality.timeliness_report(df.limit(0), "ts", datetime(2024, 1, 1), 120).first()
    assert (late.failed, late.detail, fresh.failed, empty.failed) == (1, "age_seconds=300", 0, 1)


def test_date_texts(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-1", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(quality.valid_date_text(F.col("t"))).collect()] == [
        True,
        False,
        False,
        False,
        False,
    ]


def test_mismatches_see_nulls(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "k INT, v INT")
    right = spark.createDataFrame([(1, None), (2, None), (4, 1)], "k INT, v INT")
    assert rows(quality.mismatches(left, right, ["k"])) == [
        (2, "different"),
        (3, "missing_right"),
        (4, "missing_left"),
    ]


def test_messages_are_parsed_once(spark):
    classified = quality.classify(envelopes(spark, ["{}"]))
    for side in (quality.valid_ticks(classified), quality.dead_letters(classified)):
        assert plan_of(side).count("from_json(") == 1
