from datetime import datetime

import pytest
from helpers import BASE_MS, random_ticks, rows, ticks
from pyspark.sql import functions as F

from barlake.functions.scalars import event_time
from barlake.operators import indicators as ind
from barlake.sources import messages
from barlake.streaming import freshness, hot_path, ingest


def envelopes(df, topic="stock_trades"):
    return df.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct("symbol", "price", "quantity", "trade_time")).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_millis("trade_time").alias("timestamp"),
    )


def send(df, broker):
    envelopes(df).coalesce(1).write.mode("append").json(broker)


def test_bronze_restart_adds_only_what_is_new(spark, folder):
    broker, bronze, checkpoint = (f"{folder}/{n}" for n in ("broker", "bronze", "checkpoint"))
    send(ticks(spark, random_ticks(1, 50)), broker)

    def drain():
        stream = messages.file_stream(spark, broker)
        ingest.write_bronze(stream, bronze, checkpoint).awaitTermination()
        return messages.read_bronze(spark, bronze).count()

    assert [drain(), drain()] == [50, 50]
    send(ticks(spark, random_ticks(2, 20)), broker)
    assert drain() == 70


def test_missing_or_empty_bronze_has_no_rows(spark, folder):
    assert messages.read_bronze(spark, f"{folder}/none").count() == 0
    spark.range(0).write.json(f"{folder}/empty")
    assert messages.read_bronze(spark, f"{folder}/empty").count() == 0


def test_redelivered_messages_are_dropped(spark, folder):
    df = ticks(spark, random_ticks(3, 40, days=1))
    send(df, f"{folder}/broker")
    send(df.filter("seq < 10"), f"{folder}/broker")
    stream = ingest.drop_redelivered(messages.file_stream(spark, f"{folder}/broker"), "2 days")
    ingest.write_bronze(stream, f"{folder}/bronze", f"{folder}/checkpoint").awaitTermination()
    assert messages.read_bronze(spark, f"{folder}/bronze").count() == 40


def run_hot(spark, folder, **options):
    stream = messages.file_stream(spark, f"{folder}/broker", max_files_per_batch=1)
    query = hot_path.start_hot_path(
        hot_path.hot_indicators(hot_path.tick_stream(stream), **options),
        hot_path.parquet_writer(f"{folder}/indicators"),
        f"{folder}/checkpoint",
        interval=None,
    )
    query.awaitTermination()
    return query


def test_hot_path_over_several_batches_equals_batch(spark, folder):
    data = random_ticks(4, 120, days=1)
    for piece in (data[:60], data[60:]):
        send(ticks(spark, piece), f"{folder}/broker")
    run_hot(spark, folder, watermark="1 hour")
    stored = spark.read.parquet(f"{folder}/indicators").drop("window_part")
    expected = ind.sliding_indicators(ticks(spark, data))
    rounded = [
        x.select(*expected.columns).withColumns({c: F.round(c, 9) for c in ("sma", "vwap")})
        for x in (stored, expected)
    ]
    assert rows(rounded[0]) == rows(rounded[1])


def test_settled_windows_over_several_batches_equal_batch(spark, folder):
    data = sorted(random_ticks(6, 150, days=1), key=lambda t: t[3])
    for piece in (data[:70], data[70:]):
        send(ticks(spark, piece), f"{folder}/broker")
    stream = messages.file_stream(spark, f"{folder}/broker", max_files_per_batch=1)
    windows = hot_path.settled_indicators(hot_path.tick_stream(stream), "0 seconds")
    hot_path.start_settled_path(windows, f"{folder}/settled", f"{folder}/checkpoint", None).awaitTermination()
    stored = spark.read.parquet(f"{folder}/settled").drop("window_part")
    newest = F.timestamp_millis(F.lit(BASE_MS + max(t[3] for t in data)))
    expected = ind.sliding_indicators(ticks(spark, data)).filter(F.col("window_end") <= newest)
    rounded = [
        x.select(*expected.columns).withColumns({c: F.round(c, 9) for c in ("sma", "vwap")})
        for x in (stored, expected)
    ]
    assert rows(rounded[0]) == rows(rounded[1]) and rounded[0].count() > 20


def test_late_ticks_are_dropped_and_counted_once_per_window(spark, folder):
    broker = f"{folder}/broker"
    send(ticks(spark, [("A", 1.0, 1.0, 600_000, 0)]), broker)
    send(ticks(spark, [("A", 2.0, 1.0, 601_000, 1)]), broker)
    send(ticks(spark, [("A", 9.0, 1.0, 0, 2), ("A", 3.0, 1.0, 602_000, 3)]), broker)
    late = hot_path.LateRows()
    spark.streams.addListener(late)
    try:
        query = run_hot(spark, folder)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(late)
    stored = spark.read.parquet(f"{folder}/indicators")
    assert late.dropped[str(query.id)] == 6
    assert stored.agg(F.min("window_start")).first()[0].timestamp() * 1000 >= BASE_MS + 500_000


def test_replayed_batch_changes_nothing(spark, folder):
    batch = ind.sliding_indicators(ticks(spark, random_ticks(5, 30)))
    write = hot_path.upsert_batches(hot_path.parquet_writer(f"{folder}/indicators"))
    write(batch, 0)
    before = rows(spark.read.parquet(f"{folder}/indicators"))
    write(batch, 0)
    assert rows(spark.read.parquet(f"{folder}/indicators")) == before


def test_silent_symbols_are_reported(spark, folder):
    send(ticks(spark, [("A", 1.0, 1.0, 0, 0), ("B", 1.0, 1.0, 290_000, 1)]), f"{folder}/broker")
    stream = hot_path.tick_stream(messages.file_stream(spark, f"{folder}/broker"))
    seen = []
    freshness.start_freshness_watch(
        stream,
        lambda stale: seen.extend(stale.collect()),
        f"{folder}/checkpoint",
        interval=None,
        now=F.timestamp_millis(F.lit(BASE_MS + 300_000)),
    ).awaitTermination()
    assert [(r.symbol, r.silent_seconds) for r in seen] == [("A", 300)]


def alerts_of(spark, folder, pieces, **options):
    for piece in pieces:
        send(ticks(spark, piece), f"{folder}/broker")
        stream = hot_path.tick_stream(messages.file_stream(spark, f"{folder}/broker", max_files_per_batch=1))
        freshness.write_alerts(
            freshness.silence_alerts(stream, **options), f"{folder}/alerts", f"{folder}/checkpoint", None
        ).awaitTermination()
    found = spark.read.schema(freshness.ALERT_DDL).parquet(f"{folder}/alerts").collect()
    return sorted((r.symbol, round(r.last_event.timestamp() * 1000) - BASE_MS) for r in found)


def test_each_silence_is_reported_once(spark, folder):
    # A pauses once and goes on, B falls silent for good, C never pauses.
    steady = [("C", 1.0, 1.0, t, 1000 + t) for t in range(0, 1_200_001, 100_000)]
    first = [("A", 1.0, 1.0, 0, 0), ("B", 1.0, 1.0, 10_000, 1), *steady[:8]]
    second = [("A", 1.0, 1.0, 650_000, 2), ("A", 1.0, 1.0, 740_000, 3), *steady[8:]]
    got = alerts_of(spark, folder, [first, second], threshold_seconds=120, watermark="0 seconds")
    assert got == [("A", 0), ("A", 740_000), ("B", 10_000)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        messages.kafka_stream(spark, "broker:9092", ["a", "b"])


def test_event_time(spark):
    (row,) = ticks(spark, [("A", 1.0, 1.0, 0, 0)]).select(event_time().alias("t")).collect()
    assert row.t == datetime.fromtimestamp(BASE_MS / 1000)


def test_late_windows_drops_a_tick_just_behind_the_first_watermark(spark, folder):
    from barlake.plans import queries

    rows = [(1, "01-14 23:58:40", 10.0), (20, "01-14 23:58:30", 50.0), (21, "01-16 12:00:00", 3.0), (22, "01-25 12:00:00", 4.0)]
    spark.createDataFrame(
        [(i, f"2024-{t}", 1, "a", v, '{"k": 1}') for i, t, v in rows],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")
    got = queries.registered()["late_windows"](spark, folder).collect()
    assert {r.sma for r in got} == {10.0, 3.0, 4.0} and all(r.late_ticks_noticed for r in got)
