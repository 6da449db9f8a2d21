"""Serving database over JDBC (S-13, K-6, K-7).

The write goes to a staging table of its own and is merged by one statement in
the database, inside one transaction.
"""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


# The serving tables as (column, type) and their keys, which the
# upsert relies on.
SERVING_TABLES = {
    "daily_prices": (
        [
            ("symbol", "VARCHAR(20) NOT NULL"),
            ("fetch_date", "DATE NOT NULL"),
            ("open_price", "DOUBLE PRECISION"),
            ("high_price", "DOUBLE PRECISION"),
            ("low_price", "DOUBLE PRECISION"),
            ("close_price", "DOUBLE PRECISION"),
            ("volume", "BIGINT"),
            ("currency", "VARCHAR(10)"),
            ("asset_type", "VARCHAR(20)"),
        ],
        ["symbol", "fetch_date"],
    ),
    "crypto_indicators": (
        [
            ("symbol", "VARCHAR(20) NOT NULL"),
            ("window_start", "TIMESTAMP NOT NULL"),
            ("window_end", "TIMESTAMP NOT NULL"),
            ("sma", "DOUBLE PRECISION"),
            ("vwap", "DOUBLE PRECISION"),
            ("trade_count", "INTEGER"),
        ],
        ["symbol", "window_start"],
    ),
    "daily_predictions": (
        [
            ("symbol", "VARCHAR(20) NOT NULL"),
            ("prediction_date", "DATE NOT NULL"),
            ("predicted_direction", "INTEGER NOT NULL"),
            ("probability", "DOUBLE PRECISION"),
            ("model_version", "VARCHAR(50)"),
            ("created_at", "TIMESTAMP"),
        ],
        ["symbol", "prediction_date"],
    ),
}


@dataclass(frozen=True)
class JdbcTarget:
    """Where and how to connect. ``connections`` bounds the parallel sessions."""

    url: str
    driver: str
    dialect: str = "postgresql"
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    connections: int = 8
    batch_size: int = 10_000

    def options(self) -> dict[str, str]:
        settings = {"url": self.url, "driver": self.driver, "batchsize": str(self.batch_size)}
        if self.user is not None:
            settings["user"] = self.user
        if self.password is not None:
            settings["password"] = self.password
        return settings


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    """S-13: table scan; given a numeric column and bounds, read in parallel."""
    reader = spark.read.format("jdbc").options(**target.options()).option("dbtable", table)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", target.connections)
        )
    return reader.load()


def overwrite_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """K-6: replace a (staging) table with at most ``connections`` writers."""
    (
        df.write.format("jdbc")
        .options(**target.options())
        .option("dbtable", table)
        .option("numPartitions", target.connections)
        .mode("overwrite")
        .save()
    )


def _quoted(names: list[str]) -> str:
    return ", ".join(f'"{name}"' for name in names)


def upsert_statement(
    dialect: str, table: str, staging: str, columns: list[str], keys: list[str]
) -> str:
    """The statement that moves staged rows into ``table``."""
    values = [c for c in columns if c not in keys]
    if dialect == "postgresql":
        action = (
            "DO UPDATE SET " + ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in values)
            if values
            else "DO NOTHING"
        )
        return (
            f"INSERT INTO {table} ({_quoted(columns)}) SELECT {_quoted(columns)} FROM {staging}"
            f" ON CONFLICT ({_quoted(keys)}) {action}"
        )
    if dialect in ("derby", "ansi"):
        match = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
        update = ", ".join(f'"{c}" = s."{c}"' for c in values)
        matched = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
        inserted = ", ".join(f's."{c}"' for c in columns)
        return (
            f"MERGE INTO {table} t USING {staging} s ON {match}{matched}"
            f" WHEN NOT MATCHED THEN INSERT ({_quoted(columns)}) VALUES ({inserted})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def create_statement(table: str) -> str:
    """DDL of a serving table, with the key as primary key."""
    columns, keys = SERVING_TABLES[table]
    body = ", ".join(f'"{name}" {kind}' for name, kind in columns)
    return f"CREATE TABLE {table} ({body}, PRIMARY KEY ({_quoted(keys)}))"


def create_serving_tables(
    spark: SparkSession, target: JdbcTarget, tables: list[str] | None = None
) -> None:
    """Create serving tables that do not exist yet (the caller names which)."""
    statements = [create_statement(name) for name in tables or SERVING_TABLES]
    run_in_transaction(spark, target, statements)


def run_in_transaction(spark: SparkSession, target: JdbcTarget, statements: list[str]) -> None:
    """Run statements on one driver-side connection: all of them or none."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(
        target.driver, True, jvm.java.lang.Thread.currentThread().getContextClassLoader()
    )
    properties = jvm.java.util.Properties()
    if target.user is not None:
        properties.setProperty("user", target.user)
    if target.password is not None:
        properties.setProperty("password", target.password)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_jdbc(df: DataFrame, target: JdbcTarget, table: str, keys: list[str]) -> None:
    """K-7: stage in parallel, merge by key in the database, drop the staging table."""
    spark = df.sparkSession
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    merge = upsert_statement(target.dialect, table, staging, df.columns, keys)
    try:
        overwrite_jdbc(df, target, staging)
        run_in_transaction(spark, target, [merge, f"DROP TABLE {staging}"])
    except Exception:
        # The staging table may not even exist; the first error is the one to report.
        with contextlib.suppress(Exception):
            run_in_transaction(spark, target, [f"DROP TABLE {staging}"])
        raise
