"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads whole driver tables. Doubles that depend on summation order are
rounded, so that another engine can be compared row by row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions.scalars import date_key, month_key
from barlake.operators import bars as ops
from barlake.operators import forecasting as fc
from barlake.operators import history as hist
from barlake.operators import indicators as ind
from barlake.operators import isolation
from barlake.operators import maintenance as maint
from barlake.operators import accounting, panels, quality, redelivery, star, upsert
from barlake.plans import cold_path
from barlake.plans import fixtures as fx
from barlake.plans import predictions
from barlake.session import pin_session
from barlake.sources import dimensions, messages, tables, vendors
from barlake.storage import path_exists, scratch_path
from barlake.streaming import freshness, hot_path, ingest

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, with the session settings applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(pin_session(spark), sf_dir.rstrip("/"))

    _REGISTRY[function.__name__] = run
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round in double arithmetic; the added fraction keeps halves off the boundary.

    ``rint`` stays in doubles, so NaN, infinity and any size come through.
    """
    scale = float(10**digits)
    return df.withColumns({c: F.rint(F.col(c) * scale + 0.0001) / scale for c in columns})


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- inputs several queries share ------------------------------------------------


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.daily_ohlcv(fx.event_ticks(spark, sf_dir))


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fact_daily_prices(
        fx.event_ticks(spark, sf_dir), dimensions.generate_dim_date(spark)
    )


def event_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.gold_daily_prices(
        event_fact(spark, sf_dir),
        dimensions.generate_dim_date(spark),
        fx.event_assets(spark, sf_dir),
    )


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.daily_ohlcv(fx.lineitem_ticks(spark, sf_dir), fx.lineitem_order())


def supplier_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fill_missing(ops.with_returns(supplier_bars(spark, sf_dir)))


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """Written and read back, for what several steps start from."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- bars and star schema ----------------------------------------------------------


@query
def daily_ohlcv(spark, sf_dir):
    """A-1, A-2, F-3, W-1, W-2"""
    return rounded(event_bars(spark, sf_dir), "volume_exact")


@query
def lineitem_bars(spark, sf_dir):
    """A-1 where all ticks of a day tie"""
    return rounded(
        supplier_bars(spark, sf_dir), *ops.PRICES, "volume_exact"
    )


@query
def fact_daily_prices(spark, sf_dir):
    """A-1, W-3..W-5, F-5, F-6, J-1"""
    return rounded(event_fact(spark, sf_dir), "daily_return", "price_range")


@query
def fact_counts(spark, sf_dir):
    """A-3: the row counts a load reports"""
    fact = ops.fact_daily_prices(
        fx.lineitem_ticks(spark, sf_dir), dimensions.generate_dim_date(spark), fx.lineitem_order()
    )
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.countDistinct("symbol").alias("symbols"),
        F.countDistinct("date_key").alias("days"),
    )


@query
def fact_user_prices(spark, sf_dir):
    """The fact table over many symbols"""
    fact = ops.fact_daily_prices(
        fx.user_ticks(spark, sf_dir), dimensions.generate_dim_date(spark)
    )
    return rounded(fact, "daily_return", "price_range")


@query
def gold_daily_prices(spark, sf_dir):
    """J-2, J-3, F-4"""
    return event_gold(spark, sf_dir)


@query
def bars_without_asset(spark, sf_dir):
    """J-4, P-11"""
    bars = event_bars(spark, sf_dir).select("symbol", "fetch_date", "close_price")
    return star.rows_without_match(bars, fx.event_assets(spark, sf_dir), "symbol")


@query
def bars_without_date(spark, sf_dir):
    """J-4, P-10: the dimension starts in 2000, the table before"""
    bars = supplier_bars(spark, sf_dir).select("symbol", "fetch_date", "volume")
    return star.bars_without_date(bars, dimensions.generate_dim_date(spark))


@query
def dim_date_coverage(spark, sf_dir):
    """S-12: every dimension column, with the ticks of that day"""
    per_day = (
        fx.lineitem_ticks(spark, sf_dir)
        .groupBy(ops.trade_date().alias("day_date"))
        .agg(F.count(F.lit(1)).alias("ticks"))
        .select(date_key(F.col("day_date")).alias("date_key"), "ticks")
    )
    return per_day.join(F.broadcast(dimensions.generate_dim_date(spark)), "date_key", "inner")


@query
def dim_date_csv(spark, sf_dir):
    """K-10, S-5: the traded days written as CSV and read back typed"""
    days = fx.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day_date")
    )
    path = scratch_path(spark, "dim-date-csv")
    dimensions.export_csv(dimensions.calendar_columns(days.distinct()), path)
    return dimensions.read_dim_date_csv(spark, path)


@query
def federated_join(spark, sf_dir):
    """J-6: bars with the columns of a small relational table"""
    remote = fx.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    bars = supplier_bars(spark, sf_dir).select("symbol", "fetch_date", "volume")
    return star.federated_join(bars, remote, "symbol")


@query
def stock_symbols(spark, sf_dir):
    """S-7, with the number of ticks behind each symbol"""
    chosen = dimensions.symbols_of_type(fx.event_assets(spark, sf_dir), "stock")
    counts = fx.event_ticks(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("ticks"))
    return counts.join(chosen, "symbol", "left_semi")


@query
def backfill_range(spark, sf_dir):
    """D-10: bars of a date range, from ticks filtered first"""
    ticks = fx.lineitem_ticks(spark, sf_dir)
    bars = ops.backfill_bars(ticks, "1998-01-01", "1998-03-31", fx.lineitem_order())
    return rounded(bars, *ops.PRICES, "volume_exact")


# --- messages and vendors -----------------------------------------------------------


@query
def vendor_crypto(spark, sf_dir):
    """S-9"""
    aliases = fx.event_assets(spark, sf_dir).select(
        F.concat(F.upper("symbol"), F.lit("USDT")).alias("raw_symbol"), "symbol"
    )
    return vendors.crypto_ticks(fx.crypto_payloads(spark, sf_dir), aliases, keep=("offset",))


@query
def vendor_stock(spark, sf_dir):
    """S-10"""
    return vendors.stock_ticks(fx.stock_payloads(spark, sf_dir), keep=("offset",))


@query
def vendor_daily(spark, sf_dir):
    """S-11"""
    payloads = vendors.daily_payloads(fx.daily_payload_messages(spark, sf_dir))
    return without_zone(vendors.daily_quote(payloads), "fetch_timestamp")


@query
def parsed_ticks(spark, sf_dir):
    """F-1, F-2: the reference's filter, which lets bad prices pass"""
    return messages.parse_ticks(fx.corrupted_messages(spark, sf_dir), keep=("offset",))


@query
def dead_letters(spark, sf_dir):
    """Q-1, K-9"""
    classified = quality.classify(fx.corrupted_messages(spark, sf_dir))
    return quality.dead_letters(classified).select("key", "topic", "partition", "offset", "reason")


@query
def valid_ticks(spark, sf_dir):
    """Q-1: the other side"""
    classified = quality.classify(fx.corrupted_messages(spark, sf_dir))
    return quality.valid_ticks(classified)


@query
def encoded_messages(spark, sf_dir):
    """K-11: encoding, checked by decoding"""
    encoded = messages.encode_ticks(fx.event_ticks(spark, sf_dir))
    return encoded.select("key", F.from_json("value", schemas.TICK_DDL).alias("t")).select(
        "key", "t.*"
    )


@query
def bronze_round_trip(spark, sf_dir):
    """S-3, S-4, K-1, T-1, T-2, O-6: a stream drained into bronze twice"""
    root = scratch_path(spark, "bronze")
    fx.tick_messages(spark, sf_dir).write.json(f"{root}/broker")
    for _ in range(2):
        stream = messages.file_stream(spark, f"{root}/broker")
        ingest.write_bronze(
            stream, f"{root}/bronze", f"{root}/checkpoint", by_ingest_date=True
        ).awaitTermination()
    stored = messages.read_bronze(spark, f"{root}/bronze")
    return without_zone(stored.select("key", *ingest.MESSAGE_ID, "timestamp"), "timestamp")


# --- duplicates and quality ------------------------------------------------------------


def doubled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, and every 50th once more with a later arrival time."""
    sent = fx.tick_messages(spark, sf_dir)
    again = sent.filter(F.col("offset") % 50 == 0).withColumn(
        "timestamp", F.col("timestamp") + F.expr("interval 1 second")
    )
    return sent.unionByName(again)


@query
def dedup_latest(spark, sf_dir):
    """A-7: the newest copy per message id"""
    latest = quality.keep_latest(
        doubled_messages(spark, sf_dir), ingest.MESSAGE_ID, F.unix_micros("timestamp")
    )
    return without_zone(latest.select("key", *ingest.MESSAGE_ID, "timestamp"), "timestamp")


@query
def dedup_quotes(spark, sf_dir):
    """P-2: equal quotes counted once"""
    ticks = fx.lineitem_ticks(spark, sf_dir).select(
        "symbol", "trade_time", F.round("price", 0).alias("price"), "quantity",
        F.col("l_orderkey").alias("seq"),
    )
    return quality.drop_repeated_quotes(ticks)


@query
def dedup_stream(spark, sf_dir):
    """T-8: redelivered messages dropped on the stream"""
    root = scratch_path(spark, "dedup")
    doubled_messages(spark, sf_dir).write.json(f"{root}/broker")
    stream = ingest.drop_redelivered(
        messages.file_stream(spark, f"{root}/broker"), "60 days"
    )
    ingest.write_bronze(stream, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return messages.read_bronze(spark, f"{root}/bronze").select("key", *ingest.MESSAGE_ID)


@query
def completeness(spark, sf_dir):
    """Q-2"""
    parsed = messages.parse_ticks(fx.corrupted_messages(spark, sf_dir))
    return rounded(
        quality.completeness(parsed, ["symbol", "price", "quantity", "trade_time"]), "null_rate"
    )


@query
def duplicate_keys(spark, sf_dir):
    """Q-3"""
    return quality.duplicate_keys(
        fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def quality_report(spark, sf_dir):
    """Q-2..Q-5, Q-7"""
    bars = supplier_bars(spark, sf_dir)
    calendar = dimensions.generate_dim_date(spark).select(
        F.to_date("full_date").alias("fetch_date")
    )
    return quality.table_report(
        bars,
        ops.BAR_KEYS,
        quality.bar_conditions(),
        (calendar, "fetch_date", "warn"),
        ("fetch_date", F.lit("2001-11-05 00:00:00").cast("timestamp"), 86_400, "warn"),
    )


@query
def closed_gate(spark, sf_dir):
    """Q-8: what closes the gate before a load, and what the table holds behind it"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    day = F.dayofmonth("fetch_date")
    bars = supplier_bars(spark, sf_dir).withColumns(
        {
            "low_price": F.when(day == 5, F.col("high_price") * 2).otherwise(F.col("low_price")),
            "volume": F.when(day == 6, -1).otherwise(F.col("volume")),
        }
    )
    try:
        cold_path.upsert_bars(spark, lake, bars)
        failed = []
    except quality.QualityGateError as error:
        failed = error.failed  # a row per check
    report = spark.createDataFrame(failed, quality.REPORT_DDL).select("check_name", "failed", "total")
    return report.crossJoin(
        cold_path.stored_fact(spark, lake).agg(F.count(F.lit(1)).alias("stored_bars"))
    )


@query
def invalid_dates(spark, sf_dir):
    """Q-5: date texts that are no dates, made by moving the month"""
    day = F.to_date("l_shipdate")
    text = F.concat_ws(
        "-", F.year(day), F.lpad((F.month(day) + 3).cast("string"), 2, "0"),
        F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    )
    return (
        fx.table(spark, sf_dir, "lineitem")
        .select(text.alias("date_text"))
        .filter(~quality.valid_date_text(F.col("date_text")))
        .groupBy("date_text")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query
def serving_mismatches(spark, sf_dir):
    """Q-6: a serving table with missing, surplus and changed rows"""
    silver = supplier_bars(spark, sf_dir).select("symbol", "fetch_date", "volume")
    day = F.dayofmonth("fetch_date")
    serving = silver.filter(day != 5).withColumn(
        "volume", F.when(day == 6, F.col("volume") + 1).otherwise(F.col("volume"))
    )
    return quality.mismatches(silver.filter(day != 7), serving, ["symbol", "fetch_date"])


# --- upserts, history, maintenance --------------------------------------------------------


def keyed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier bars with ``date_key`` and ``month_key``, computed."""
    return ops.with_key_of_date(supplier_bars(spark, sf_dir)).select(
        "symbol", "date_key", "volume", month_key(F.col("date_key")).alias("month_key")
    )


KEYED_DDL = "symbol STRING, date_key INT, volume BIGINT, month_key INT"


@query
def merge_upsert(spark, sf_dir):
    """K-5, J-5, K-12: two loads that overlap on every fourth day"""
    path = f"{scratch_path(spark, 'merge')}/bars"
    bars = stored_once(keyed_bars(spark, sf_dir), "keyed-bars")
    first = bars.filter(F.col("date_key") % 2 == 0)
    second = bars.filter((F.col("date_key") % 2 == 1) | (F.col("date_key") % 4 == 0)).withColumn(
        "volume", F.col("volume") + 1000
    )
    for load in (first, second, second):
        upsert.merge_upsert(
            spark, path, load, ["symbol", "date_key"], ["month_key"], KEYED_DDL
        )
    return spark.read.schema(KEYED_DDL).parquet(path)


@query
def refreshed_returns(spark, sf_dir):
    """P-8, P-9: what is written when some bars change"""
    stored = ops.with_key_of_date(supplier_returns(spark, sf_dir))
    changed = stored.filter(F.col("date_key") % 7 == 0).withColumn(
        "close_price", F.col("close_price") * 2
    )
    return rounded(
        ops.refresh_fact(changed, stored).select(*ops.FACT_KEYS, "close_price", "daily_return"),
        "close_price",
        "daily_return",
    )


@query
def change_events(spark, sf_dir):
    """D-11: updates and deletes, several per key"""
    target = keyed_bars(spark, sf_dir).drop("month_key")
    version = F.pmod(F.col("date_key") + F.lit(1), F.lit(11))
    updates = target.filter(F.col("date_key") % 3 == 0).select(
        "symbol", "date_key", (F.col("volume") + 5).alias("volume"),
        F.lit(1).alias("version"), F.lit("u").alias("op"),
    )
    later = target.filter(F.col("date_key") % 3 == 0).select(
        "symbol", "date_key", (F.col("volume") + 7).alias("volume"),
        F.lit(2).alias("version"), F.when(version == 0, "d").otherwise("u").alias("op"),
    )
    return upsert.apply_changes(
        target, updates.unionByName(later), ["symbol", "date_key"]
    )


HISTORY_DDL = (
    "symbol STRING, date_key INT, volume BIGINT, valid_from BIGINT, valid_to BIGINT, year_key INT"
)


def bar_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored versions of the bars: most of them, every third changed, every fifth changed."""
    path = f"{scratch_path(spark, 'history')}/bars"
    keyed = keyed_bars(spark, sf_dir).select(
        "symbol", "date_key", "volume", F.floor(F.col("date_key") / 10000).cast("int").alias("year_key")
    )
    bars = stored_once(keyed, "keyed-bars")
    volume = F.col("volume")
    for version, rows in enumerate(
        (
            bars.filter(F.col("date_key") % 10 != 9),
            bars.filter(F.col("date_key") % 3 == 0).withColumn("volume", volume + 1),
            bars.filter(F.col("date_key") % 5 == 0).withColumn("volume", volume + 2),
        ),
        start=1,
    ):
        hist.store_version(
            spark, path, rows, ["symbol", "date_key"], version, ["year_key"], HISTORY_DDL
        )
    return spark.read.schema(HISTORY_DDL).parquet(path).drop("year_key")


@query
def history_versions(spark, sf_dir):
    """D-1, M13"""
    return hist.versions(bar_history(spark, sf_dir))


@query
def as_of_version(spark, sf_dir):
    """D-2"""
    return hist.as_of(bar_history(spark, sf_dir), 2)


@query
def expired_history(spark, sf_dir):
    """D-3: the last two versions kept"""
    return hist.expire_versions(bar_history(spark, sf_dir), retain_last=2)


@query
def partition_listing(spark, sf_dir):
    """D-4, K-2"""
    path = scratch_path(spark, "listing")
    tables.append(keyed_bars(spark, sf_dir), path, ["month_key"])
    listed = tables.partition_listing(
        spark.read.schema(KEYED_DDL).parquet(path), ["month_key"]
    )
    return listed.select("month_key", "row_count")


@query
def compacted_table(spark, sf_dir):
    """D-5, D-9: files and rows per partition after two runs, and what the runs did"""
    path = f"{scratch_path(spark, 'compact')}/bars"
    bars = keyed_bars(spark, sf_dir).withColumn(
        "month_key", F.floor(F.col("month_key") / 100).cast("int")
    )
    with maint.unsorted_writes(spark):
        bars.repartition(8, "symbol", "date_key").write.partitionBy("month_key").parquet(path)
    step = ("bars", "compact", lambda: maint.compact(spark, path, ["month_key"], KEYED_DDL))
    done = maint.maintain(spark, [step, step])
    table = spark.read.schema(KEYED_DDL).parquet(path)
    listed = tables.partition_listing(table, ["month_key"])
    volumes = table.groupBy("month_key").agg(F.sum("volume").alias("volume"))
    return listed.join(volumes, "month_key").select(
        "month_key",
        "row_count",
        "volume",
        "file_count",
        F.lit(done.filter("error IS NOT NULL").count()).cast("long").alias("failures"),
        F.lit(done.filter("after < before").count()).cast("long").alias("runs_that_rewrote"),
    )


@query
def orphan_partitions(spark, sf_dir):
    """D-6: the partitions with files that the sink of a stream does not know"""
    root = scratch_path(spark, "orphans")
    bars = keyed_bars(spark, sf_dir)
    bars.write.parquet(f"{root}/source")
    (
        spark.readStream.schema(KEYED_DDL)
        .parquet(f"{root}/source")
        .writeStream.format("parquet")
        .partitionBy("month_key")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/table")
        .awaitTermination()
    )
    # What an attempt leaves that fails before it commits.
    tables.append(bars.filter(F.col("date_key") % 100 == 31), f"{root}/table", ["month_key"])
    return (
        maint.sink_orphans(spark, f"{root}/table")
        .select(*maint.partition_of("file_path", ["month_key"]))
        .distinct()
        .select(F.col("month_key").cast("int").alias("month_key"))
    )


LAYOUT_DDL = f"{KEYED_DDL}, source STRING, year INT"


def two_layouts(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of bars: older ones by month and without a column, newer ones by year."""
    root = scratch_path(spark, "layout")
    bars = keyed_bars(spark, sf_dir)
    tables.append(bars.filter(F.col("month_key") < 199901), f"{root}/by_month", ["month_key"])
    newer = bars.filter(F.col("month_key") >= 199901).withColumns(
        {"year": F.floor(F.col("month_key") / 100).cast("int"), "source": F.lit("feed")}
    )
    tables.append(newer, f"{root}/by_year", ["year"])
    return f"{root}/by_month", f"{root}/by_year"


@query
def evolved_layout(spark, sf_dir):
    """D-7, D-8: old files without a column and under another partitioning"""
    by_month, by_year = two_layouts(spark, sf_dir)
    both = hist.union_layouts(
        spark.read.schema(KEYED_DDL).parquet(by_month),
        spark.read.schema(LAYOUT_DDL).parquet(by_year),
    )
    return hist.drop_columns(both, "year")


@query
def rewritten_layout(spark, sf_dir):
    """D-8: the older folder moved into the newer one, by a second run nothing more"""
    by_month, by_year = two_layouts(spark, sf_dir)
    year = F.floor(F.col("month_key") / 100).cast("int")
    moved = [
        hist.rewrite_layout(
            spark, by_month, by_year, ["year"], KEYED_DDL, LAYOUT_DDL, lambda old: old.withColumn("year", year)
        )
        for _ in range(2)
    ]
    stored = spark.read.schema(LAYOUT_DDL).parquet(by_year)
    return hist.drop_columns(stored, "year").withColumns(
        {"runs_that_moved": F.lit(sum(moved)), "old_folder_left": F.lit(path_exists(spark, by_month))}
    )


@query
def described_fact(spark, sf_dir):
    """D-7: the schema of a stored table, with the null rate of each of its columns"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    bars = ops.with_key_of_date(supplier_bars(spark, sf_dir)).withColumn(
        "month_key", month_key(F.col("date_key"))
    )
    tables.append(bars.drop("fetch_date"), lake.fact, ["month_key"])
    stored = cold_path.stored_fact(spark, lake)
    rates = quality.completeness(stored, stored.columns)
    return tables.describe(stored).join(rates, F.col("col_name") == F.col("column_name")).drop("column_name")


@query
def seeded_assets(spark, sf_dir):
    """K-3, K-4, K-2, S-8: seeding twice adds nothing"""
    path = scratch_path(spark, "assets")
    assets = fx.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("symbol"),
        F.col("p_name").alias("name"),
        F.lower("p_type").alias("asset_type"),
        F.lit("USD").alias("currency"),
    )
    half = assets.filter(F.col("asset_type") < "m")
    for rows in (half, assets, assets):
        tables.seed(rows, path, schemas.DIM_ASSETS_DDL, ["symbol"], ["asset_type"])
    return tables.read_parquet_or_empty(spark, path, schemas.DIM_ASSETS_DDL)


# --- indicators ------------------------------------------------------------------------


@query
def hot_indicators(spark, sf_dir):
    """T-4, A-4..A-6"""
    windows = ind.sliding_indicators(fx.event_ticks(spark, sf_dir))
    return without_zone(rounded(windows, "sma", "vwap"), "window_start", "window_end")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, be it one file or a folder of parts."""
    schema = fx.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


@query
def hot_indicators_stream(spark, sf_dir):
    """T-1..T-7, T-10, K-8: the stream drained into an upserted table"""
    root = scratch_path(spark, "hot")
    stream = event_stream(spark, sf_dir)
    ticks = fx.event_columns(stream).withColumn("event_time", hot_path.event_time())
    hot_path.start_hot_path(
        hot_path.hot_indicators(ticks),
        hot_path.parquet_writer(f"{root}/indicators", "day"),
        f"{root}/checkpoint",
        interval=None,
    ).awaitTermination()
    stored = spark.read.parquet(f"{root}/indicators").drop("window_part")
    return without_zone(rounded(stored, "sma", "vwap"), "window_start", "window_end")


@query
def late_windows(spark, sf_dir):
    """T-3, T-5, T-6: four batches on a timer, the last one behind the watermark and noticed"""
    root = scratch_path(spark, "late")
    sent = fx.tick_messages(spark, sf_dir)
    day = F.dayofmonth("timestamp")
    early, late = day < 15, F.col("offset") % 20 == 0
    # A batch drops what is behind the watermark that the batch before it ran with, so two lie in between.
    for part in (early & ~late, ~early & (day < 23), ~early & (day >= 23), early & late):
        sent.filter(part).coalesce(1).write.mode("append").json(f"{root}/broker")
    ticks = hot_path.tick_stream(messages.file_stream(spark, f"{root}/broker", max_files_per_batch=1))
    dropped = hot_path.LateRows()
    spark.streams.addListener(dropped)
    try:
        running = hot_path.start_hot_path(
            hot_path.hot_indicators(ticks),
            hot_path.parquet_writer(f"{root}/indicators", "day"),
            f"{root}/checkpoint",
            interval="1 second",
        )
        try:
            running.processAllAvailable()
        finally:
            running.stop()
        # Progress reaches the listener a little later than the rows reach the table.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(dropped)
    noticed = dropped.dropped.get(str(running.id), 0) > 0
    stored = spark.read.schema(schemas.INDICATORS_DDL).parquet(f"{root}/indicators").drop("window_part")
    windows = without_zone(rounded(stored, "sma", "vwap"), "window_start", "window_end")
    return windows.withColumn("late_ticks_noticed", F.lit(noticed))


@query
def settled_indicators_stream(spark, sf_dir):
    """T-3, T-4: panes and windows as two stateful aggregates, windows appended when complete"""
    root = scratch_path(spark, "settled")
    ticks = fx.event_columns(event_stream(spark, sf_dir)).withColumn("event_time", hot_path.event_time())
    hot_path.start_settled_path(
        hot_path.settled_indicators(ticks, "10 minutes"), f"{root}/indicators", f"{root}/checkpoint", None, "day"
    ).awaitTermination()
    stored = spark.read.schema(schemas.INDICATORS_DDL).parquet(f"{root}/indicators").drop("window_part")
    return without_zone(rounded(stored, "sma", "vwap"), "window_start", "window_end")


@query
def daily_vwap(spark, sf_dir):
    """A-5 per day"""
    return rounded(ind.daily_vwap(fx.event_ticks(spark, sf_dir), ops.trade_date()), "vwap")


@query
def feed_gaps(spark, sf_dir):
    """T-9 in batch"""
    gaps = ind.feed_gaps(fx.event_ticks(spark, sf_dir))
    return without_zone(gaps, "gap_start", "gap_end")


@query
def stale_feeds_stream(spark, sf_dir):
    """T-9 on a stream: users silent for more than an hour at a fixed time"""
    root = scratch_path(spark, "stale")
    stream = event_stream(spark, sf_dir)
    ticks = stream.select(
        F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )
    freshness.start_freshness_watch(
        ticks,
        lambda stale: stale.write.mode("overwrite").parquet(f"{root}/stale"),
        f"{root}/checkpoint",
        threshold_seconds=3600,
        interval=None,
        now=F.lit("2024-01-31 00:00:00").cast("timestamp"),
    ).awaitTermination()
    return without_zone(spark.read.parquet(f"{root}/stale"), "last_event")


@query
def silence_alerts(spark, sf_dir):
    """T-9 with state and timers: every silence of a user over six hours, once"""
    root = scratch_path(spark, "silences")
    ticks = event_stream(spark, sf_dir).select(
        F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )
    freshness.write_alerts(
        freshness.silence_alerts(ticks, 21_600, "0 seconds"), f"{root}/alerts", f"{root}/checkpoint", None
    ).awaitTermination()
    stored = spark.read.schema(freshness.ALERT_DDL).parquet(f"{root}/alerts")
    return without_zone(stored, "last_event", "silent_after")


@query
def sma(spark, sf_dir):
    """W-6"""
    frame = ind.with_moving_averages(supplier_bars(spark, sf_dir))
    return rounded(
        frame.select("symbol", "fetch_date", "sma_5", "sma_10", "sma_20"),
        "sma_5", "sma_10", "sma_20",
    )


@query
def lags(spark, sf_dir):
    """W-7: t-1 .. t-7"""
    frame = ind.with_lags(
        event_bars(spark, sf_dir), {"close_price": "close"}, (1, 2, 3, 4, 5, 6, 7)
    )
    return frame.select("symbol", "fetch_date", *[f"close_lag_{k}" for k in range(1, 8)])


@query
def volatility(spark, sf_dir):
    """W-10"""
    frame = ind.with_volatility(ind.with_step_returns(supplier_bars(spark, sf_dir)))
    names = ["return_1", "return_4", "return_24", "volatility_20"]
    return rounded(frame.select("symbol", "fetch_date", *names), *names)


@query
def price_ratios(spark, sf_dir):
    """W-10: close against SMA and VWAP"""
    bars = ops.bars_with_vwap(fx.event_ticks(spark, sf_dir))
    names = ["price_sma_5_ratio", "price_vwap_ratio"]
    frame = ind.with_price_ratios(bars, 5, "vwap")
    return rounded(frame.select("symbol", "fetch_date", *names), *names)


@query
def rsi(spark, sf_dir):
    """W-11"""
    frame = ind.with_rsi(supplier_bars(spark, sf_dir))
    return rounded(frame.select("symbol", "fetch_date", "rsi_14", "rsi_signal"), "rsi_14")


@query
def ema(spark, sf_dir):
    """W-12"""
    frame = ind.with_emas(supplier_bars(spark, sf_dir), (5, 20))
    return rounded(frame.select("symbol", "fetch_date", "ema_5", "ema_20"), "ema_5", "ema_20")


@query
def volume_anomaly(spark, sf_dir):
    """W-15"""
    frame = ind.with_volume_anomaly(supplier_bars(spark, sf_dir))
    return rounded(frame.select("symbol", "fetch_date", "volume_z", "is_abnormal"), "volume_z")


@query
def isolated_bars(spark, sf_dir):
    """W-15: unusual bars by return, range and volume together; every 500th volume is planted"""
    bars = supplier_returns(spark, sf_dir).withColumn("planted", F.pmod(F.xxhash64(*ops.BAR_KEYS), F.lit(500)) == 0)
    bars = bars.withColumn(
        "log_volume", F.log1p(F.when(F.col("planted"), F.col("volume") * 1000000).otherwise(F.col("volume")).cast("double"))
    )
    features = ("daily_return", "price_range", "log_volume")
    bars = stored_once(bars.select(*ops.BAR_KEYS, "planted", *features), "forest-bars")
    forest = isolation.fit_forest(bars, ops.BAR_KEYS, features)
    scored = isolation.with_isolation(bars, ops.BAR_KEYS, forest)
    return rounded(
        scored.select(*ops.BAR_KEYS, "planted", "isolation_score", "is_isolated"), "isolation_score"
    )


@query
def volume_ranks(spark, sf_dir):
    """W-9"""
    frame = ind.with_ranks(supplier_bars(spark, sf_dir), "volume")
    return frame.select("symbol", "fetch_date", "row_number", "rank", "dense_rank")


# --- panels -------------------------------------------------------------------------------


@query
def panel_prices(spark, sf_dir):
    """O-1, F-7"""
    return panels.price_panel(event_gold(spark, sf_dir))


@query
def panel_volume(spark, sf_dir):
    """O-2"""
    return rounded(panels.volume_panel(event_gold(spark, sf_dir)), "log10_volume")


@query
def panel_latest(spark, sf_dir):
    """O-3"""
    return panels.latest_prices(event_gold(spark, sf_dir))


@query
def latest_indicators(spark, sf_dir):
    """O-4"""
    newest = panels.latest_indicators(ind.sliding_indicators(fx.event_ticks(spark, sf_dir)))
    return without_zone(rounded(newest, "sma", "vwap"), "window_start", "window_end")


@query
def preview(spark, sf_dir):
    """O-5, F-9"""
    bars = supplier_bars(spark, sf_dir).select("symbol", "fetch_date", "volume")
    chosen = spark.sql("SELECT * FROM {bars} WHERE volume > 0", bars=bars)
    return panels.preview(chosen, 5, ["fetch_date", "symbol"])


@query
def symbol_history(spark, sf_dir):
    """F-8"""
    fact = ops.with_fetch_date(event_fact(spark, sf_dir)).select(
        "symbol", "fetch_date", "close_price", "volume"
    )
    return panels.symbol_history(fact, "click", F.lit("2024-01-30").cast("date"), days=10)


@query
def weekly_prices(spark, sf_dir):
    """A-8 by week"""
    return rounded(panels.period_prices(supplier_bars(spark, sf_dir), "week"), "avg_close")


@query
def monthly_prices(spark, sf_dir):
    """A-8 by month"""
    return rounded(panels.period_prices(supplier_bars(spark, sf_dir), "month"), "avg_close")


@query
def volume_rollup(spark, sf_dir):
    """A-8 with subtotals"""
    return panels.volume_rollup(supplier_bars(spark, sf_dir))


@query
def cumulative_volume(spark, sf_dir):
    """A-8: accumulating trend"""
    return panels.cumulative_volume(supplier_bars(spark, sf_dir))


@query
def market_summary(spark, sf_dir):
    """A-9"""
    return rounded(panels.market_summary(supplier_returns(spark, sf_dir)), "mean_return", digits=4)


# --- models and forecasts ---------------------------------------------------------------------


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts from a fixed rule, the sign of the last return, on most days."""
    bars = supplier_returns(spark, sf_dir)
    last_return = F.lag("daily_return", 1).over(ops.symbol_window())
    direction = F.when(last_return > 0, 1).otherwise(0)
    return (
        bars.withColumn("predicted_direction", direction)
        .filter(F.dayofmonth("fetch_date") % 5 != 0)
        .select(
            "symbol",
            F.col("fetch_date").alias("prediction_date"),
            "predicted_direction",
            F.when(F.col("predicted_direction") == 1, 0.6).otherwise(0.4).alias("probability"),
        )
    )


def compared(spark: SparkSession, sf_dir: str, lag_after_join: bool = False) -> DataFrame:
    return fc.forecast_vs_actual(
        rule_predictions(spark, sf_dir), supplier_bars(spark, sf_dir), lag_after_join
    )


@query
def ml_features(spark, sf_dir):
    """L-1, W-6..W-8, W-10, W-11"""
    frame = fc.feature_frame(supplier_returns(spark, sf_dir))
    names = [c for c in fc.FEATURES if c != "volume_lag_1"]
    frame = frame.select("symbol", "fetch_date", *fc.FEATURES, "target")
    return rounded(frame, *names)


@query
def ml_split(spark, sf_dir):
    """L-2"""
    path = scratch_path(spark, "split")
    supplier_bars(spark, sf_dir).select("symbol", "fetch_date").write.parquet(path)
    return fc.with_split(spark.read.parquet(path))


@query
def forecast_vs_actual(spark, sf_dir):
    """J-7, W-13, L-6"""
    return rounded(compared(spark, sf_dir), "actual_close")


@query
def forecast_vs_actual_panel(spark, sf_dir):
    """J-7 with the lag after the join"""
    return rounded(compared(spark, sf_dir, lag_after_join=True), "actual_close")


@query
def losing_streaks(spark, sf_dir):
    """W-14"""
    return fc.losing_streaks(compared(spark, sf_dir))


@query
def direction_metrics(spark, sf_dir):
    """A-10"""
    return rounded(
        fc.direction_metrics(compared(spark, sf_dir)), "accuracy", "precision", "recall", "f1_score"
    )


@query
def regression_metrics(spark, sf_dir):
    """A-10 for the forecast that nothing changes"""
    scored = fc.with_targets(supplier_bars(spark, sf_dir))
    return rounded(
        fc.regression_metrics(scored, "next_close", "close_price"), "rmse", "mae", digits=4
    )


MODEL = fc.ModelSettings()


@query
def direction_model(spark, sf_dir):
    """L-3, L-5, L-7: train, store with metrics, load, predict the test dates, upsert twice"""
    frame = predictions.split_features(supplier_returns(spark, sf_dir))
    root, path = scratch_path(spark, "models"), f"{scratch_path(spark, 'predictions')}/daily"
    predictions.train_version(frame, root, "v1", MODEL)
    predicted = fc.predict_direction(
        fc.load_model(root, "v1"),
        frame.filter("split = 'test'"),
        dimensions.generate_dim_date(spark),
        "v1",
        MODEL,
        created_at="2024-01-01 00:00:00",
    )
    predicted = stored_once(predicted, "predicted")
    for _ in range(2):
        predictions.store_predictions(spark, path, predicted)
    stored = spark.read.schema(predictions.STORED_DDL).parquet(path)
    agrees = F.col("predicted_direction").isin(0, 1) & F.col("probability").between(0.5, 1.0)
    metrics = spark.read.json(f"{root}/v1/metrics").first()
    return stored.select(
        "symbol",
        "prediction_date",
        "model_version",
        agrees.alias("direction_agrees"),
        F.lit(metrics["n"]).cast("long").alias("n_scored"),
        F.lit(0 <= metrics["accuracy"] <= 1).alias("has_accuracy"),
    )


def regressor(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Rows learnt from and scored, and whether the errors are numbers."""
    frame = predictions.split_features(supplier_returns(spark, sf_dir))
    complete = frame.dropna(subset=[*MODEL.features, label])
    train, test = (complete.filter(F.col("split") == part) for part in ("train", "test"))
    model = fc.train_regressor(train, label, MODEL)
    errors = fc.regression_metrics(model.transform(test), label)
    return errors.select(
        F.lit(label).alias("label"),
        F.lit(train.count()).cast("long").alias("n_train"),
        F.col("n").alias("n_test"),
        ((F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0)).alias("errors_are_ordered"),
    )


@query
def volatility_model(spark, sf_dir):
    """L-4: RMSE and MAE of the next day's range"""
    return regressor(spark, sf_dir, "next_range")


@query
def close_model(spark, sf_dir):
    """L-8: RMSE and MAE of the next close"""
    return regressor(spark, sf_dir, "next_close")


# --- the whole pipeline ---------------------------------------------------------------------------


@query
def cold_path_gold(spark, sf_dir):
    """T-11: broken messages and those of an unlisted topic through bronze and silver to gold, in two runs"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    tables.append(fx.event_assets(spark, sf_dir), lake.assets, ["asset_type"])
    sent = fx.corrupted_messages(spark, sf_dir)
    other = sent.filter(F.col("offset") % 5 == 0).withColumn("topic", F.lit("unlisted"))
    sent = sent.unionByName(other)
    broker = f"{lake.root}/broker"
    for part in (0, 1):
        sent.filter(F.col("offset") % 2 == part).write.mode("append").json(broker)
        cold_path.run_cold_path(spark, lake, messages.file_stream(spark, broker))
    return spark.read.schema(schemas.GOLD_DDL).parquet(lake.gold).drop("year")


@query
def load_accounting(spark, sf_dir):
    """J-4, Q-4, P-10, P-11: bars and symbols left out by two loads and a sync, with the reason"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    tables.append(fx.customer_assets(spark, sf_dir), lake.assets, ["asset_type"])
    sent = fx.order_messages(spark, sf_dir)
    load = cold_path.silver_batch(lake, cold_path.TOPICS)
    for batch in (0, 1):
        load(sent.filter(F.col("offset") % 2 == batch), batch)
    cold_path.silver_to_gold(spark, lake)
    return accounting.load_report(spark, lake.load_counts, lake.dropped_symbols)


@query
def redelivered_fact(spark, sf_dir):
    """A-7, T-8: half of the messages, then all of them and some twice, change nothing twice"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    sent = fx.tick_messages(spark, sf_dir)
    load = cold_path.silver_batch(lake, cold_path.TOPICS)
    load(sent.filter(F.col("offset") % 4096 < 2048), 0)
    load(doubled_messages(spark, sf_dir), 1)
    return rounded(
        cold_path.stored_fact(spark, lake).select(*ops.FACT_COLUMNS), "daily_return", "price_range"
    )


@query
def stored_vwap(spark, sf_dir):
    """A-5, W-10: VWAP of stored bars that took in their ticks in two loads"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    sent = fx.tick_messages(spark, sf_dir)
    load = cold_path.silver_batch(lake, cold_path.TOPICS)
    for batch in (0, 1):
        load(sent.filter((F.col("offset") % 1000 < 500) == (batch == 0)), batch)
    bars = cold_path.stored_fact(spark, lake).select("symbol", "date_key", ops.vwap().alias("vwap"))
    return rounded(bars, "vwap")


@query
def catalog_fact(spark, sf_dir):
    """K-3, S-8: the declared fact table after two loads into its folder"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    database = f"star_{uuid.uuid4().hex}"
    tables.create_star_schema(spark, database, lake.star)
    sent = fx.tick_messages(spark, sf_dir)
    load = cold_path.silver_batch(lake, cold_path.TOPICS)
    for batch in (0, 1):
        load(sent.filter((F.col("offset") % 1000 < 500) == (batch == 0)), batch)
        tables.recover_star_schema(spark, database, lake.star)
    fact = tables.read_table(spark, f"{database}.fact_daily_prices")
    return rounded(fact.select(*ops.FACT_COLUMNS), "daily_return", "price_range")


@query
def offset_intervals(spark, sf_dir):
    """T-8: the intervals that stand for a batch with gaps"""
    sent = fx.tick_messages(spark, sf_dir).filter((F.col("offset") % 97 != 0) & (F.col("offset") % 1000 < 900))
    return redelivery.batch_intervals(sent, redelivery.offset_blocks(sent))


@query
def stored_dead_letters(spark, sf_dir):
    """K-9: the dead letters of a cold path run, read back and counted by reason and topic"""
    lake = cold_path.Lake(scratch_path(spark, "lake"))
    sent = fx.corrupted_messages(spark, sf_dir)
    other = sent.filter(F.col("offset") % 5 == 0).withColumn("topic", F.lit("unlisted"))
    sent.unionByName(other).write.json(f"{lake.root}/broker")
    cold_path.ingest(messages.file_stream(spark, f"{lake.root}/broker"), lake)
    cold_path.bronze_to_silver(spark, lake)
    stored = spark.read.json(lake.dead_letters)
    return stored.groupBy("reason", "topic").agg(F.count(F.lit(1)).alias("messages"))
