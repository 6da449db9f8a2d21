"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    """One spelling per value, whichever engine it comes from."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def sorted_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = connection.execute(sql)
    sql_columns = [d[0] for d in result.description]
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns: {sorted(spark_df.columns)} != {sorted(sql_columns)}"
    expected = sorted_rows(sql_columns, result.fetchall())
    actual = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        return f"rows: {len(actual)} != {len(expected)}; spark {actual[:2]} sql {expected[:2]}"
    pairs = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    if not pairs:
        return None
    return f"{len(pairs)} of {len(actual)} rows, first {sorted(spark_df.columns)}: {pairs[:2]}"
