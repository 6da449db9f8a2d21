"""Data quality: dead letters, duplicates, checks and the gate (Q-1..Q-8, A-7)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake import schemas
from barlake.functions.parsing import with_parsed
from barlake.functions.scalars import is_bad_price, is_bad_quantity, is_bad_time

CORRUPT = "_corrupt"
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DatetimeType)

REPORT_DDL = (
    "check_name STRING, dimension STRING, level STRING, failed BIGINT, total BIGINT, detail STRING"
)


# --- Q-1: dead letters ----------------------------------------------------------


def dead_letter_reason(parsed: Column, value: Column) -> Column:
    """Why a message is no usable tick, or null. The first reason that fits wins."""
    corrupt = parsed.isNull() | parsed[CORRUPT].isNotNull()
    return (
        F.when(corrupt & F.try_parse_json(value).isNull(), "unparseable")
        .when(corrupt, "type_mismatch")
        .when(parsed["symbol"].isNull(), "null_symbol")
        .when(is_bad_time(parsed["trade_time"]), "bad_time")
        .when(is_bad_price(parsed["price"]), "bad_price")
        .when(is_bad_quantity(parsed["quantity"]), "bad_quantity")
    )


def _position_reason(topics: list[str]) -> Column:
    """Why a message has no place in the order of ticks."""
    missing = F.col("partition").isNull() | F.col("offset").isNull()
    return F.when(~F.coalesce(F.col("topic").isin(topics), F.lit(False)), "unknown_topic").when(
        missing | (F.col("partition") < 0) | (F.col("offset") < 0), "bad_position"
    )


def classify(messages: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """Q-1: every message with its parsed tick and a ``reason``, null when valid.

    One parse serves both outputs; filter the result, or store it partitioned
    by ``is_valid``, to get at either. With ``topics``, messages of other topics or
    without a place in theirs are no ticks either.
    """
    parsed = F.from_json(
        "value",
        f"{schemas.TICK_DDL}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    reason = dead_letter_reason(F.col("tick"), F.col("value"))
    if topics is not None:
        reason = F.coalesce(_position_reason(topics), reason)
    return (
        with_parsed(messages, "tick", parsed)
        .withColumn("reason", reason)
        .withColumn("is_valid", F.col("reason").isNull())
    )


def valid_ticks(
    classified: DataFrame, keep: tuple[str, ...] = ("topic", "partition", "offset")
) -> DataFrame:
    return classified.filter("is_valid").select(
        "tick.symbol", "tick.price", "tick.quantity", "tick.trade_time", *keep
    )


def dead_letters(classified: DataFrame) -> DataFrame:
    """K-9: what goes to the dead-letter table, with the message untouched."""
    return classified.filter(~F.col("is_valid")).select(
        "key", "value", "topic", "partition", "offset", "timestamp", "reason"
    )


# --- A-7: duplicates --------------------------------------------------------------


def keep_latest(df: DataFrame, keys: list[str], order_key: Column) -> DataFrame:
    """A-7: the row with the highest ``order_key`` of each key.

    An aggregate, not a window: copies are folded before the shuffle, so a key
    with most of the rows does not reach one task. ``order_key`` must be total
    inside a key, and fixed-width for hash aggregation.
    """
    rest = [c for c in df.columns if c not in keys]
    keyed = df.withColumn("_order", order_key)
    if not rest:
        return df.select(*keys).distinct()
    if all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in rest):
        latest = keyed.groupBy(*keys).agg(*[F.max_by(c, "_order").alias(c) for c in rest])
    else:
        latest = (
            keyed.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), "_order").alias("_latest"))
            .select(*keys, "_latest.*")
        )
    return latest.select(*df.columns)


def drop_repeated_quotes(ticks: DataFrame, seq: str = "seq") -> DataFrame:
    """P-2: of ticks equal in symbol, time, price and quantity, the first stays."""
    return ticks.groupBy("symbol", "trade_time", "price", "quantity").agg(F.min(seq).alias(seq))


# --- Q-2..Q-7: checks ---------------------------------------------------------------


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q-2: null rate per column, in one pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return rates.unpivot([], columns, "column_name", "null_rate")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q-3: keys that occur more than once."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    )


def _failures(condition: Column) -> Column:
    """Rows where the condition is not true; null does not pass."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def _count_report(
    df: DataFrame, checks: list[tuple[str, str, str, Column]]
) -> DataFrame:
    """``(name, dimension, level, condition)`` checks over one pass."""
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT_DDL)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[_failures(condition).alias(f"c{i}") for i, (_, _, _, condition) in enumerate(checks)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(dimension).alias("dimension"),
                F.lit(level).alias("level"),
                F.col(f"c{i}").alias("failed"),
            )
            for i, (name, dimension, level, _) in enumerate(checks)
        ]
    )
    return counted.select(F.explode(rows).alias("r"), "total").select(
        "r.check_name",
        "r.dimension",
        "r.level",
        "r.failed",
        "total",
        F.lit(None).cast("string").alias("detail"),
    )


def bar_conditions() -> list[tuple[str, str, str, Column]]:
    """Q-2, Q-4, Q-5 for bars with ``fetch_date``."""
    low, high = F.col("low_price"), F.col("high_price")
    prices = [F.col(c) for c in ("open_price", "high_price", "low_price", "close_price")]
    return [
        ("symbol_present", "completeness", "error", F.col("symbol").isNotNull()),
        ("date_present", "completeness", "error", F.col("fetch_date").isNotNull()),
        (
            "prices_present",
            "completeness",
            "error",
            reduce(lambda a, b: a & b, [p.isNotNull() for p in prices]),
        ),
        ("prices_positive", "accuracy", "error", F.least(*prices) > 0),
        ("volume_not_negative", "accuracy", "error", F.col("volume") >= 0),
        (
            "open_in_range",
            "accuracy",
            "error",
            F.col("open_price").between(low, high),
        ),
        (
            "close_in_range",
            "accuracy",
            "error",
            F.col("close_price").between(low, high),
        ),
        ("symbol_format", "validity", "warn", valid_symbol(F.col("symbol"))),
    ]


def valid_symbol(symbol: Column) -> Column:
    """Q-5: upper-case letters, digits, dots and dashes."""
    return symbol.rlike("^[A-Z0-9][A-Z0-9.-]*$")


def valid_date_text(text: Column) -> Column:
    """Q-5: a real date written yyyy-MM-dd."""
    return text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text).isNotNull()


def uniqueness_report(df: DataFrame, keys: list[str], level: str = "error") -> DataFrame:
    """Q-3 as report rows: surplus rows over distinct keys."""
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    ).select(
        F.lit("unique_" + "_".join(keys)).alias("check_name"),
        F.lit("uniqueness").alias("dimension"),
        F.lit(level).alias("level"),
        "failed",
        "total",
        F.lit(None).cast("string").alias("detail"),
    )


def coverage_report(
    df: DataFrame, dimension: DataFrame, key: str, level: str = "warn"
) -> DataFrame:
    """Q-4: rows without a partner in a dimension (P-10, P-11)."""
    known = dimension.select(key, F.lit(True).alias("_known")).distinct()
    return (
        df.select(key)
        .join(known, key, "left")
        .agg(
            F.count_if(F.col("_known").isNull()).alias("failed"),
            F.count(F.lit(1)).alias("total"),
        )
        .select(
            F.lit(f"known_{key}").alias("check_name"),
            F.lit("accuracy").alias("dimension"),
            F.lit(level).alias("level"),
            "failed",
            "total",
            F.lit(None).cast("string").alias("detail"),
        )
    )


def timeliness_report(
    df: DataFrame, at: str, as_of: datetime | Column, max_age_seconds: int, level: str = "warn"
) -> DataFrame:
    """Q-7: age of the newest row against ``as_of``."""
    reference = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = df.agg(F.max(at).cast("timestamp").alias("newest"))
    age = F.unix_seconds(reference.cast("timestamp")) - F.unix_seconds("newest")
    return newest.select(
        F.lit(f"fresh_{at}").alias("check_name"),
        F.lit("timeliness").alias("dimension"),
        F.lit(level).alias("level"),
        F.coalesce((age > max_age_seconds).cast("bigint"), F.lit(1)).alias("failed"),
        F.lit(1).cast("bigint").alias("total"),
        F.concat(F.lit("age_seconds="), age).alias("detail"),
    )


def mismatches(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Q-6: keys missing on one side, or with any column different."""
    values = [c for c in left.columns if c not in keys]
    joined = left.select(*keys, F.struct(*values).alias("l")).join(
        right.select(*keys, F.struct(*values).alias("r")), keys, "full_outer"
    )
    status = (
        F.when(F.col("r").isNull(), "missing_right")
        .when(F.col("l").isNull(), "missing_left")
        .when(~F.col("l").eqNullSafe(F.col("r")), "different")
    )
    return joined.select(*keys, status.alias("status")).filter(F.col("status").isNotNull())


def table_report(
    df: DataFrame,
    keys: list[str],
    conditions: list[tuple[str, str, str, Column]],
    coverage: tuple[DataFrame, str, str] | None = None,
    timeliness: tuple[str, datetime | Column, int, str] | None = None,
) -> DataFrame:
    """Q-2..Q-5, Q-7 in one pass: row checks, key uniqueness, coverage and age.

    Rows are folded by key before the shuffle, each group with its number of rows and of failures
    of every check; all report rows come from one aggregate over the groups. ``coverage`` is
    (dimension, one of the keys, level), ``timeliness`` (column, as of, largest age in seconds, level).
    """
    counted = [F.count(F.lit(1)).alias("_n")]
    counted += [_failures(condition).alias(f"_c{i}") for i, (*_, condition) in enumerate(conditions)]
    if timeliness is not None:
        counted.append(F.max(timeliness[0]).alias("_newest"))
    groups = df.groupBy(*keys).agg(*counted)
    total, zero = F.coalesce(F.sum("_n"), F.lit(0)), F.lit(0).cast("bigint")
    totals = [total.alias("_total"), F.coalesce(F.sum(F.col("_n") - 1), zero).alias("_surplus")]
    totals += [F.coalesce(F.sum(f"_c{i}"), zero).alias(f"_c{i}") for i in range(len(conditions))]
    none, rows = F.lit(None).cast("string"), []

    def row(name: str, dimension: str, level: str, failed: Column, of: Column, detail: Column = none) -> None:
        values = {"check_name": F.lit(name), "dimension": F.lit(dimension), "level": F.lit(level)}
        values |= {"failed": failed.cast("bigint"), "total": of.cast("bigint"), "detail": detail}
        rows.append(F.struct(*[value.alias(field) for field, value in values.items()]))

    for i, (name, dimension, level, _) in enumerate(conditions):
        row(name, dimension, level, F.col(f"_c{i}"), F.col("_total"))
    row(f"unique_{'_'.join(keys)}", "uniqueness", "error", F.col("_surplus"), F.col("_total"))
    if coverage is not None:
        known, key, level = coverage
        groups = groups.join(known.select(key, F.lit(True).alias("_known")).distinct(), key, "left")
        totals.append(F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), zero).alias("_unknown"))
        row(f"known_{key}", "accuracy", level, F.col("_unknown"), F.col("_total"))
    if timeliness is not None:
        at, as_of, max_age, level = timeliness
        reference = as_of if isinstance(as_of, Column) else F.lit(as_of)
        age = F.unix_seconds(reference.cast("timestamp")) - F.unix_seconds(F.col("_newest").cast("timestamp"))
        totals.append(F.max("_newest").alias("_newest"))
        late = F.coalesce((age > max_age).cast("bigint"), F.lit(1))
        row(f"fresh_{at}", "timeliness", level, late, F.lit(1), F.concat(F.lit("age_seconds="), age))
    return groups.agg(*totals).select(F.inline(F.array(*rows)))


def bars_report(bars: DataFrame) -> DataFrame:
    """Row checks and key uniqueness of a batch of bars."""
    return table_report(bars, ["symbol", "fetch_date"], bar_conditions())


class QualityGateError(RuntimeError):
    """Raised when an error-level check failed; ``failed`` has the report rows."""

    def __init__(self, message: str, failed: list[Row]):
        super().__init__(message)
        self.failed = failed


def gate(report: DataFrame) -> DataFrame:
    """Q-8: raise when an error-level check failed, else hand the report on.

    Only failed checks come to the driver: at most one row per check.
    """
    failed = report.filter((F.col("level") == "error") & (F.col("failed") > 0)).collect()
    if failed:
        names = ", ".join(f"{r['check_name']} ({r['failed']} of {r['total']})" for r in failed)
        raise QualityGateError(f"quality gate closed: {names}", failed)
    return report
