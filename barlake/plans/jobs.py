"""Command line of the jobs, for ``spark-submit`` and schedulers.

    spark-submit barlake/plans/jobs.py setup     --root s3a://bucket/lake --symbols symbols.json
    spark-submit barlake/plans/jobs.py cold-path --root s3a://bucket/lake --servers broker:9092
    spark-submit barlake/plans/jobs.py hot-path  --root s3a://bucket/lake --servers broker:9092
    spark-submit barlake/plans/jobs.py maintain  --root s3a://bucket/lake
    spark-submit barlake/plans/jobs.py freshness --root s3a://bucket/lake --servers broker:9092
    spark-submit barlake/plans/jobs.py predict   --root s3a://bucket/lake --model-version v1

``--messages`` reads messages from a folder of JSON files instead of a broker.
Errors propagate, so a failed job has a failing exit code.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.operators import accounting, maintenance, redelivery
from barlake.operators.bars import with_fetch_date
from barlake.plans import cold_path, predictions
from barlake.session import build_session, pin_session
from barlake.sources import dimensions, messages, tables
from barlake.sources.jdbc import JdbcTarget, create_serving_tables, upsert_jdbc
from barlake.storage import has_files
from barlake.streaming import freshness, hot_path

GOLD_KEYS = ["symbol", "fetch_date"]


def parser() -> argparse.ArgumentParser:
    arguments = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    arguments.add_argument("job", choices=sorted(JOBS))
    arguments.add_argument("--root", required=True, help="lake folder on shared storage")
    arguments.add_argument("--symbols", help="symbols config, for setup")
    arguments.add_argument("--servers", help="broker addresses")
    arguments.add_argument("--messages", help="folder of message files, instead of a broker")
    arguments.add_argument("--topics", default=",".join(cold_path.TOPICS))
    arguments.add_argument("--jdbc-url", help="serving database; without it serving is Parquet")
    arguments.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    arguments.add_argument("--jdbc-dialect", default="postgresql")
    arguments.add_argument("--jdbc-user")
    arguments.add_argument("--jdbc-password-file", help="file that holds the password")
    arguments.add_argument("--database", help="catalog database to declare the star schema in")
    arguments.add_argument("--interval", default="10 seconds", help="trigger of the streams")
    arguments.add_argument("--silence", type=int, default=120, help="seconds without a tick")
    arguments.add_argument("--settled", action="store_true", help="hot path: append complete windows")
    arguments.add_argument("--model-version", default="v1", help="a new name for each training")
    arguments.add_argument("--drain", action="store_true", help="streams: stop when drained")
    return arguments


def _stream(spark: SparkSession, options, starting_offsets: str) -> DataFrame:
    if options.messages:
        return messages.file_stream(spark, options.messages)
    return messages.kafka_stream(
        spark, options.servers, options.topics.split(","), starting_offsets
    )


def _database(options) -> JdbcTarget | None:
    if not options.jdbc_url:
        return None
    password = None
    if options.jdbc_password_file:
        with open(options.jdbc_password_file) as file:
            password = file.read().rstrip("\n")
    return JdbcTarget(
        options.jdbc_url, options.jdbc_driver, options.jdbc_dialect, options.jdbc_user, password
    )


def setup(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    """Declare the tables, write the date dimension, seed the assets from the symbols config.

    Bars of a symbol that was unknown so far reach the serving table with the
    next sync, hence all months become due. With a database the star schema is declared over the
    lake's folders; with a serving database its tables are created there. Repeating it is harmless.
    """
    if options.database:
        tables.create_star_schema(spark, options.database, lake.star)
    database = _database(options)
    if database is not None:
        create_serving_tables(spark, database)
    if not has_files(spark, lake.dim_date):
        tables.replace_partitions(dimensions.generate_dim_date(spark), lake.dim_date, ["year"])
    assets = dimensions.read_symbols(spark, options.symbols)
    tables.seed(assets, lake.assets, schemas.DIM_ASSETS_DDL, ["symbol"], ["asset_type"])
    cold_path.mark_due(cold_path.stored_fact(spark, lake), lake)
    _recover(spark, lake, options)


def _recover(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    if options.database:
        tables.create_star_schema(spark, options.database, lake.star)
        tables.recover_star_schema(spark, options.database, lake.star)


def cold(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    database = _database(options)
    write = None
    if database is not None:
        write = lambda rows: upsert_jdbc(rows, database, "daily_prices", GOLD_KEYS)
    cold_path.run_cold_path(
        spark,
        lake,
        _stream(spark, options, "earliest"),
        options.topics.split(","),
        write,
    )
    _recover(spark, lake, options)
    accounting.load_report(spark, lake.load_counts, lake.dropped_symbols).filter(
        "dropped_bars > 0"
    ).orderBy(F.desc("batch_id"), "step", "reason").show(20, truncate=False)


def hot(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    ticks = hot_path.tick_stream(_stream(spark, options, "latest"))
    interval = None if options.drain else options.interval
    if options.settled:
        hot_path.start_settled_path(
            hot_path.settled_indicators(ticks),
            lake.settled_indicators,
            lake.checkpoint("settled_path"),
            interval,
        ).awaitTermination()
        return
    database = _database(options)
    write = (
        hot_path.parquet_writer(lake.indicators)
        if database is None
        else hot_path.jdbc_writer(database, "crypto_indicators")
    )
    hot_path.start_hot_path(
        hot_path.hot_indicators(ticks), write, lake.checkpoint("hot_path"), interval
    ).awaitTermination()


def fresh(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    """Append an alert for every symbol that falls silent, once per silence."""
    ticks = hot_path.tick_stream(_stream(spark, options, "latest"))
    freshness.write_alerts(
        freshness.silence_alerts(ticks, options.silence),
        lake.alerts,
        lake.checkpoint("freshness"),
        None if options.drain else options.interval,
    ).awaitTermination()


def maintain(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    """Compact every lake table; a failing table does not stop the others, but fails the job.

    Of the indicators, which the hot path writes all the time, only hours are
    rewritten that lie well behind its watermark.
    """
    settled = F.col("window_part") < F.date_format(
        F.current_timestamp() - F.expr("INTERVAL 3 HOURS"), hot_path.GRAINS["hour"]
    ).cast("int")
    layouts = {
        lake.assets: (["asset_type"], schemas.DIM_ASSETS_DDL),
        lake.fact: (cold_path.FACT_PARTITIONS, schemas.FACT_TABLE_DDL),
        lake.gold: (["year"], f"{schemas.GOLD_DDL}, year INT"),
        lake.indicators: (["window_part"], f"{schemas.INDICATORS_DDL}, window_part INT"),
    }
    limits = {lake.indicators: settled}

    def step(path: str, columns: list[str], ddl: str) -> tuple[int, int]:
        if not has_files(spark, path):
            return 0, 0
        return maintenance.compact(spark, path, columns, ddl, only=limits.get(path))

    steps = [
        (path, "compact", lambda p=path, c=columns, d=ddl: step(p, c, d))
        for path, (columns, ddl) in layouts.items()
    ]
    # Younger files may belong to an attempt that is still running.
    settled_files = F.current_timestamp() - F.expr("INTERVAL 3 DAYS")
    for path, pattern in ((lake.bronze, "*.json"), (lake.alerts, "*.parquet"), (lake.settled_indicators, "*.parquet")):
        if has_files(spark, f"{path}/_spark_metadata"):
            clean = lambda p=path, g=pattern: maintenance.remove_orphans(spark, p, g, settled_files)
            steps.append((path, "remove orphans", clean))
    if has_files(spark, lake.offsets):
        offsets = lambda: redelivery.compact_intervals(spark, lake.offsets)
        steps.append((lake.offsets, "merge intervals", offsets))
    done = maintenance.maintain(spark, steps)
    done.show(truncate=False)
    # One row per table.
    failed = [row["table_name"] for row in done.filter("error IS NOT NULL").collect()]
    if failed:
        raise RuntimeError(f"maintenance failed for {', '.join(failed)}")


def predict(spark: SparkSession, lake: cold_path.Lake, options) -> None:
    """Train a model version on the stored bars and predict each symbol's next day."""
    bars = with_fetch_date(cold_path.stored_fact(spark, lake))
    predictions.predict_newest(
        spark, bars, lake.models, options.model_version, lake.predictions
    )


JOBS = {
    "setup": setup,
    "cold-path": cold,
    "hot-path": hot,
    "maintain": maintain,
    "predict": predict,
    "freshness": fresh,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parser().parse_args(argv)
    session = build_session(options.job) if spark is None else pin_session(spark)
    JOBS[options.job](session, cold_path.Lake(options.root), options)


if __name__ == "__main__":
    main()
