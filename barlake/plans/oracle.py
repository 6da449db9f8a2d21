"""The registered queries in SQL over the same tables, for another engine."""

from __future__ import annotations

# --- shared CTEs -----------------------------------------------------------------

TICKS = """ticks AS (
  SELECT event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         epoch_us(ts) // 1000 AS trade_time, event_id AS seq, CAST(ts AS DATE) AS fetch_date
  FROM events)"""

USER_TICKS = TICKS.replace("event_type AS symbol", "'U' || user_id AS symbol")

_BARS = """{name} AS (
  SELECT symbol, fetch_date,
         arg_min(price, {order}) AS open_price, max(price) AS high_price,
         min(price) AS low_price, arg_max(price, {order}) AS close_price,
         COALESCE(CAST(trunc(sum(quantity)) AS BIGINT), 0) AS volume,
         sum(quantity) AS volume_exact
  FROM {source} GROUP BY symbol, fetch_date)"""

BARS = _BARS.format(name="bars", order="(trade_time, seq)", source="ticks")

SUPPLIER_TICKS = """sticks AS (
  SELECT 'S' || l_suppkey AS symbol, l_extendedprice / l_quantity AS price,
         l_quantity AS quantity, CAST(l_shipdate AS DATE) AS fetch_date,
         epoch_us(l_shipdate) // 1000 AS trade_time,
         l_orderkey, l_linenumber, l_extendedprice, l_quantity
  FROM lineitem)"""

SUPPLIER_BARS = _BARS.format(
    name="sbars",
    order="(l_orderkey, l_linenumber, l_extendedprice, l_quantity)",
    source="sticks",
)

_RETURNS = """{name} AS (
  SELECT *, COALESCE(CASE WHEN prev_close > 0
                THEN (close_price - prev_close) / prev_close * 100 ELSE 0.0 END, 0.0) AS daily_return,
         COALESCE(CASE WHEN low_price > 0
                THEN (high_price - low_price) / low_price * 100 ELSE 0.0 END, 0.0) AS price_range
  FROM (SELECT *, lag(close_price) OVER (PARTITION BY symbol ORDER BY fetch_date) AS prev_close
        FROM {source}))"""

RETURNS = _RETURNS.format(name="rets", source="bars")
SUPPLIER_RETURNS = _RETURNS.format(name="srets", source="sbars")

ASSETS = """assets AS (
  SELECT DISTINCT event_type AS symbol,
         CASE WHEN event_type IN ('click', 'view') THEN 'crypto' ELSE 'stock' END AS asset_type,
         'USD' AS currency
  FROM events WHERE event_type <> 'signup')"""

DATE_KEY = "CAST(strftime(fetch_date, '%Y%m%d') AS INTEGER)"
IN_DIM = "fetch_date BETWEEN DATE '2000-01-01' AND DATE '2050-12-31'"

GOLD = f"""gold AS (
  SELECT b.symbol, fetch_date, open_price, high_price, low_price, close_price, volume,
         currency, asset_type
  FROM rets b JOIN assets a ON a.symbol = b.symbol WHERE {IN_DIM})"""

# The same rule that breaks the messages.
BROKEN = """broken AS (
  SELECT *, CASE WHEN symbol IN ('click', 'view') THEN 'crypto_trades' ELSE 'stock_trades' END AS topic,
         CAST(seq % 3 AS INTEGER) AS partition,
         CASE WHEN seq % 97 = 0 THEN 'unparseable' WHEN seq % 89 = 0 THEN 'null_symbol'
              WHEN seq % 83 = 0 THEN 'type_mismatch' WHEN seq % 79 = 0 THEN 'bad_quantity' END AS reason
  FROM ticks)"""

WINDOWS = """windows AS (
  SELECT symbol, make_timestamp((s.start - 10 * k) * 1000000) AS window_start,
         make_timestamp((s.start - 10 * k + 60) * 1000000) AS window_end,
         steady(avg(price), 6) AS sma,
         steady(CASE WHEN sum(quantity) > 0 THEN sum(price * quantity) / sum(quantity)
                    ELSE avg(price) END, 6) AS vwap,
         CAST(count(price) AS INTEGER) AS trade_count
  FROM (SELECT *, trade_time // 10000 * 10 AS start FROM ticks) s,
       (SELECT unnest(range(6)) AS k)
  GROUP BY symbol, s.start - 10 * k)"""

# Bars with all features (the longest looks back over 20), and whether another bar follows.
LEARNABLE = """learnable AS (
  SELECT symbol, fetch_date, more, CASE WHEN fetch_date <= (SELECT quantile_disc(d, 0.8) FROM
    (SELECT DISTINCT fetch_date AS d FROM sbars)) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT symbol, fetch_date, row_number() OVER w AS n, lead(fetch_date) OVER w IS NOT NULL AS more
        FROM sbars WINDOW w AS (PARTITION BY symbol ORDER BY fetch_date)) b WHERE n >= 20)"""

KEYED = f"""keyed AS (
  SELECT symbol, {DATE_KEY} AS date_key, volume, {DATE_KEY} // 100 AS month_key FROM sbars)"""

_PERIODS = """periods AS (
  SELECT symbol, CAST(date_trunc('{period}', fetch_date) AS DATE) AS period_start,
         steady(avg(close_price), 6) AS avg_close, CAST(sum(volume) AS BIGINT) AS volume,
         count(*) AS bars
  FROM sbars GROUP BY 1, 2)"""

PREDICTIONS = """predictions AS (
  SELECT symbol, fetch_date, CASE WHEN r > 0 THEN 1 ELSE 0 END AS predicted_direction,
         CASE WHEN r > 0 THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS probability
  FROM (SELECT *, lag(daily_return) OVER (PARTITION BY symbol ORDER BY fetch_date) AS r FROM srets)
  WHERE day(fetch_date) % 5 <> 0)"""

COMPARED = """compared AS (
  SELECT CAST(fetch_date AS TIMESTAMP) AS time, symbol, predicted_direction, probability,
         steady(close_price, 6) AS actual_close,
         CASE WHEN close_price > prev_close THEN 1 ELSE 0 END AS actual_direction
  FROM predictions JOIN srets USING (symbol, fetch_date))"""

HISTORY = """h AS (
  SELECT *, CASE WHEN date_key % 10 <> 9 THEN 1 WHEN date_key % 3 = 0 THEN 2
                 WHEN date_key % 5 = 0 THEN 3 END AS born FROM keyed),
history AS (
  SELECT symbol, date_key, volume, 1 AS valid_from,
         CASE WHEN date_key % 3 = 0 THEN 2 WHEN date_key % 5 = 0 THEN 3 END AS valid_to
  FROM keyed WHERE date_key % 10 <> 9
  UNION ALL
  SELECT symbol, date_key, volume + 1, 2, CASE WHEN date_key % 5 = 0 THEN 3 END
  FROM keyed WHERE date_key % 3 = 0
  UNION ALL
  SELECT symbol, date_key, volume + 2, 3, NULL FROM keyed WHERE date_key % 5 = 0)"""

_TIED = "OVER (PARTITION BY symbol ORDER BY fetch_date"


def _spell_rounding(sql: str) -> str:
    """``steady(x, n)`` in plain arithmetic, the same steps as on the Spark side.

    Engines disagree on exact halves; the added fraction keeps halves off the
    boundary.
    """
    head, call, rest = sql.partition("steady(")
    if not call:
        return sql
    depth, comma = 1, 0
    for end, char in enumerate(rest):
        depth += {"(": 1, ")": -1}.get(char, 0)
        if char == "," and depth == 1:
            comma = end
        if depth == 0:
            break
    value, digits = _spell_rounding(rest[:comma]), int(rest[comma + 1 : end])
    scaled = f"floor(({value}) * 1e{digits} + 0.5001::DOUBLE) / 1e{digits}"
    return f"{head}({scaled}){_spell_rounding(rest[end + 1 :])}"


def _sql(select: str, *ctes: str, recursive: bool = False) -> str:
    statement = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {select}"
    return _spell_rounding(statement)


def _events(select: str, *ctes: str) -> str:
    return _sql(select, TICKS, BARS, *ctes)


def _suppliers(select: str, *ctes: str) -> str:
    return _sql(select, SUPPLIER_TICKS, SUPPLIER_BARS, *ctes)


def _mean(column: str, n: int) -> str:
    frame = f"{_TIED} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({column}) {frame} = {n} THEN avg({column}) {frame} END"


def _moves(source: str) -> str:
    return f"""moves AS (
  SELECT *, close_price - lag(close_price) {_TIED}) AS move FROM {source}),
gains AS (
  SELECT *, count(move) {_TIED} ROWS 13 PRECEDING) AS n,
         avg(CASE WHEN move > 0 THEN move WHEN move IS NOT NULL THEN 0 END)
             {_TIED} ROWS 13 PRECEDING) AS gain,
         avg(CASE WHEN move < 0 THEN -move WHEN move IS NOT NULL THEN 0 END)
             {_TIED} ROWS 13 PRECEDING) AS loss
  FROM moves),
strength AS (
  SELECT *, CASE WHEN n = 14 THEN CASE WHEN gain = 0 AND loss = 0 THEN 50.0 WHEN loss = 0 THEN 100.0
                 ELSE 100 - 100 / (1 + gain / loss) END END AS rsi_value
  FROM gains)"""


def _ema(n: int) -> str:
    alpha = 2.0 / (n + 1)
    return f"""ema{n} AS (
  SELECT symbol, i, fetch_date, close_price AS e FROM numbered WHERE i = 1
  UNION ALL
  SELECT b.symbol, b.i, b.fetch_date, {alpha!r} * b.close_price + {1 - alpha!r} * p.e
  FROM ema{n} p JOIN numbered b ON b.symbol = p.symbol AND b.i = p.i + 1)"""


def _check(name: str, dimension: str, level: str, failed: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{dimension}' AS dimension, '{level}' AS level,"
        f" {failed} AS failed, count(*) AS total, CAST(NULL AS VARCHAR) AS detail FROM sbars"
    )


def _not(condition: str) -> str:
    return f"count(*) FILTER (WHERE NOT COALESCE({condition}, false))"


_PRICES = ("open_price", "high_price", "low_price", "close_price")

QUALITY = " UNION ALL ".join(
    [
        _check("symbol_present", "completeness", "error", _not("symbol IS NOT NULL")),
        _check("date_present", "completeness", "error", _not("fetch_date IS NOT NULL")),
        _check(
            "prices_present",
            "completeness",
            "error",
            _not(" AND ".join(f"{p} IS NOT NULL" for p in _PRICES)),
        ),
        _check(
            "prices_positive", "accuracy", "error", _not(f"least({', '.join(_PRICES)}) > 0")
        ),
        _check("volume_not_negative", "accuracy", "error", _not("volume >= 0")),
        _check(
            "open_in_range", "accuracy", "error", _not("open_price BETWEEN low_price AND high_price")
        ),
        _check(
            "close_in_range",
            "accuracy",
            "error",
            _not("close_price BETWEEN low_price AND high_price"),
        ),
        _check(
            "symbol_format",
            "validity",
            "warn",
            _not("regexp_full_match(symbol, '[A-Z0-9][A-Z0-9.-]*')"),
        ),
        _check(
            "unique_symbol_fetch_date",
            "uniqueness",
            "error",
            "count(*) - count(DISTINCT (symbol, fetch_date))",
        ),
        _check("known_fetch_date", "accuracy", "warn", _not(IN_DIM)),
        "SELECT 'fresh_fetch_date', 'timeliness', 'warn',"
        " CAST(epoch(TIMESTAMP '2001-11-05') - epoch(max(fetch_date)) > 86400 AS BIGINT), 1,"
        " 'age_seconds=' || CAST(epoch(TIMESTAMP '2001-11-05') - epoch(max(fetch_date)) AS BIGINT)"
        " FROM sbars",
    ]
)


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


_LAGS = {f"close_lag_{k}": f"lag(close_price, {k}) {_TIED})" for k in range(1, 8)}


def _step(k: int) -> str:
    return f"close_price / lag(close_price, {k}) {_TIED}) - 1"


FACT_SELECT = (
    f"SELECT symbol, {DATE_KEY} AS date_key, open_price, high_price, low_price, close_price, volume,"
    " steady(daily_return, 6) AS daily_return, steady(price_range, 6) AS price_range"
    f" FROM rets WHERE {IN_DIM}"
)

CALENDAR = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
  CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend"""

ROUNDED_BAR = ", ".join(f"steady({c}, 6) AS {c}" for c in _PRICES)

QUOTE_SECONDS = "trade_time // 1000 * 1000"


def statements() -> dict[str, str]:
    return {
        "daily_ohlcv": _events(
            "SELECT symbol, fetch_date, open_price, high_price, low_price, close_price, volume,"
            " steady(volume_exact, 6) AS volume_exact FROM bars"
        ),
        "lineitem_bars": _suppliers(
            f"SELECT symbol, fetch_date, {ROUNDED_BAR}, volume,"
            " steady(volume_exact, 6) AS volume_exact FROM sbars"
        ),
        "fact_daily_prices": _events(FACT_SELECT, RETURNS),
        "fact_counts": _suppliers(
            "SELECT count(*) AS fact_rows, count(DISTINCT symbol) AS symbols,"
            f" count(DISTINCT fetch_date) AS days FROM sbars WHERE {IN_DIM}"
        ),
        "fact_user_prices": _sql(FACT_SELECT, USER_TICKS, BARS, RETURNS),
        "gold_daily_prices": _events("SELECT * FROM gold", RETURNS, ASSETS, GOLD),
        "bars_without_asset": _events(
            "SELECT symbol, fetch_date, close_price FROM bars b"
            " WHERE NOT EXISTS (SELECT 1 FROM assets a WHERE a.symbol = b.symbol)",
            ASSETS,
        ),
        "bars_without_date": _suppliers(
            f"SELECT fetch_date, symbol, volume FROM sbars WHERE NOT ({IN_DIM})"
        ),
        "dim_date_coverage": (
            f"SELECT {CALENDAR}, count(*) AS ticks FROM"
            " (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)"
            " WHERE year(d) BETWEEN 2000 AND 2050 GROUP BY d"
        ),
        "dim_date_csv": (
            f"SELECT {CALENDAR} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"
        ),
        "federated_join": _suppliers(
            "SELECT symbol, fetch_date, volume, s_name AS name, s_nationkey AS nation FROM sbars"
            " JOIN supplier ON symbol = 'S' || s_suppkey"
        ),
        "stock_symbols": (
            "SELECT event_type AS symbol, count(*) AS ticks FROM events"
            " WHERE event_type NOT IN ('click', 'view', 'signup') GROUP BY event_type"
        ),
        "backfill_range": _suppliers(
            f"SELECT symbol, fetch_date, {ROUNDED_BAR}, volume,"
            " steady(volume_exact, 6) AS volume_exact FROM sbars"
            " WHERE fetch_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"
        ),
        "vendor_crypto": _sql(
            "SELECT symbol, price, quantity, trade_time, seq AS \"offset\" FROM ticks"
            " WHERE symbol <> 'signup'",
            TICKS,
        ),
        "vendor_stock": _sql(
            "SELECT symbol, price, CAST(1 AS DOUBLE) AS quantity,"
            f" {QUOTE_SECONDS} AS trade_time, seq AS \"offset\" FROM ticks"
            " WHERE seq % 10 <> 0 AND seq % 11 <> 0",
            TICKS,
        ),
        "vendor_daily": _sql(
            "SELECT symbol, upper(symbol[1]) || symbol[2:] AS name, 'stock' AS asset_type,"
            " make_timestamp(trade_time // 1000 * 1000000) AS fetch_timestamp, price,"
            f" {QUOTE_SECONDS} AS trade_time FROM ticks WHERE seq % 11 <> 0",
            TICKS,
        ),
        "parsed_ticks": _sql(
            "SELECT symbol, CASE WHEN reason IS DISTINCT FROM 'type_mismatch' THEN price END AS price,"
            " CASE WHEN reason = 'bad_quantity' THEN -1 - quantity ELSE quantity END AS quantity,"
            " CASE WHEN reason IS DISTINCT FROM 'type_mismatch' THEN trade_time END AS trade_time,"
            " seq AS \"offset\" FROM broken"
            " WHERE reason IS NULL OR reason IN ('type_mismatch', 'bad_quantity')",
            TICKS,
            BROKEN,
        ),
        "dead_letters": _sql(
            "SELECT symbol AS key, topic, partition, seq AS \"offset\", reason FROM broken"
            " WHERE reason IS NOT NULL",
            TICKS,
            BROKEN,
        ),
        "valid_ticks": _sql(
            "SELECT symbol, price, quantity, trade_time, topic, partition, seq AS \"offset\""
            " FROM broken WHERE reason IS NULL",
            TICKS,
            BROKEN,
        ),
        "encoded_messages": _sql(
            "SELECT symbol AS key, symbol, price, quantity, trade_time FROM ticks", TICKS
        ),
        "bronze_round_trip": _sql(
            "SELECT symbol AS key, topic, partition, seq AS \"offset\","
            " make_timestamp(trade_time * 1000) AS timestamp FROM broken",
            TICKS,
            BROKEN,
        ),
        "dedup_latest": _sql(
            "SELECT symbol AS key, topic, partition, seq AS \"offset\","
            " make_timestamp((trade_time + CASE WHEN seq % 50 = 0 THEN 1000 ELSE 0 END) * 1000)"
            " AS timestamp FROM broken",
            TICKS,
            BROKEN,
        ),
        "dedup_quotes": _sql(
            "SELECT symbol, trade_time, round(price) AS price, quantity, min(l_orderkey) AS seq"
            " FROM sticks GROUP BY 1, 2, 3, 4",
            SUPPLIER_TICKS,
        ),
        "dedup_stream": _sql(
            "SELECT symbol AS key, topic, partition, seq AS \"offset\" FROM broken", TICKS, BROKEN
        ),
        "completeness": _sql(
            "SELECT u.column_name, steady(u.rate, 6) AS null_rate FROM (SELECT"
            " avg(CASE WHEN reason = 'type_mismatch' THEN 1.0::DOUBLE ELSE 0 END) AS bad FROM broken"
            " WHERE reason IS NULL OR reason IN ('type_mismatch', 'bad_quantity')),"
            " LATERAL (VALUES ('symbol', 0.0::DOUBLE), ('price', bad), ('quantity', 0.0::DOUBLE),"
            " ('trade_time', bad)) u(column_name, rate)",
            TICKS,
            BROKEN,
        ),
        "duplicate_keys": (
            "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem"
            " GROUP BY ALL HAVING count(*) > 1"
        ),
        "quality_report": _suppliers(QUALITY),
        "closed_gate": _suppliers(
            """SELECT check_name, failed, total, CAST(0 AS BIGINT) AS stored_bars FROM (
                 SELECT unnest(['open_in_range', 'close_in_range', 'volume_not_negative']) AS check_name,
                        unnest([count(*) FILTER (day(fetch_date) = 5), count(*) FILTER (day(fetch_date) = 5),
                                count(*) FILTER (day(fetch_date) = 6)]) AS failed,
                        unnest([count(*), count(*), count(*)]) AS total FROM sbars) WHERE failed > 0"""
        ),
        "invalid_dates": (
            "SELECT t AS date_text, count(*) AS row_count FROM (SELECT year(l_shipdate) || '-' ||"
            " lpad(CAST(month(l_shipdate) + 3 AS VARCHAR), 2, '0') || '-' ||"
            " lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') AS t FROM lineitem)"
            " WHERE try_cast(t AS DATE) IS NULL GROUP BY t"
        ),
        "serving_mismatches": _suppliers(
            "SELECT symbol, fetch_date, CASE day(fetch_date) WHEN 5 THEN 'missing_right'"
            " WHEN 6 THEN 'different' ELSE 'missing_left' END AS status FROM sbars"
            " WHERE day(fetch_date) IN (5, 6, 7)"
        ),
        "merge_upsert": _suppliers(
            "SELECT symbol, date_key, volume + CASE WHEN date_key % 2 = 1 OR date_key % 4 = 0"
            " THEN 1000 ELSE 0 END AS volume, month_key FROM keyed",
            KEYED,
        ),
        "refreshed_returns": _suppliers(
            "SELECT symbol, date_key, steady(close_price, 6) AS close_price, steady(CASE WHEN p > 0"
            " THEN (close_price - p) / p * 100 ELSE 0.0 END, 6) AS daily_return FROM (SELECT *,"
            " lag(close_price) OVER w AS p, lag(changed) OVER w AS after_change FROM (SELECT symbol,"
            f" {DATE_KEY} AS date_key, {DATE_KEY} % 7 = 0 AS changed, close_price *"
            f" CASE WHEN {DATE_KEY} % 7 = 0 THEN 2 ELSE 1 END AS close_price FROM sbars)"
            " WINDOW w AS (PARTITION BY symbol ORDER BY date_key)) WHERE changed OR after_change"
        ),
        "change_events": _suppliers(
            "SELECT symbol, date_key, volume + CASE WHEN date_key % 3 = 0 THEN 7 ELSE 0 END AS volume"
            " FROM keyed WHERE NOT (date_key % 3 = 0 AND (date_key + 1) % 11 = 0)",
            KEYED,
        ),
        "history_versions": _suppliers(
            "SELECT CAST(version AS BIGINT) AS version, CAST(sum(a) AS BIGINT) AS rows_added,"
            " CAST(sum(r) AS BIGINT) AS rows_removed FROM"
            " (SELECT valid_from AS version, 1 AS a, 0 AS r FROM history UNION ALL"
            " SELECT valid_to, 0, 1 FROM history WHERE valid_to IS NOT NULL) GROUP BY version",
            KEYED,
            HISTORY,
        ),
        "as_of_version": _suppliers(
            "SELECT symbol, date_key, volume FROM history"
            " WHERE valid_from <= 2 AND (valid_to IS NULL OR valid_to > 2)",
            KEYED,
            HISTORY,
        ),
        "expired_history": _suppliers(
            "SELECT symbol, date_key, volume, CAST(valid_from AS BIGINT) AS valid_from,"
            " CAST(valid_to AS BIGINT) AS valid_to FROM history"
            " WHERE valid_to IS NULL OR valid_to > 2",
            KEYED,
            HISTORY,
        ),
        "partition_listing": _suppliers(
            "SELECT month_key, count(*) AS row_count FROM keyed GROUP BY month_key", KEYED
        ),
        "compacted_table": _suppliers(
            "SELECT month_key // 100 AS month_key, count(*) AS row_count,"
            " CAST(sum(volume) AS BIGINT) AS volume, CAST(1 AS BIGINT) AS file_count,"
            " CAST(0 AS BIGINT) AS failures, CAST(1 AS BIGINT) AS runs_that_rewrote"
            " FROM keyed GROUP BY ALL",
            KEYED,
        ),
        "orphan_partitions": _suppliers(
            "SELECT DISTINCT month_key FROM keyed WHERE date_key % 100 = 31", KEYED
        ),
        "evolved_layout": _suppliers(
            "SELECT symbol, date_key, volume, month_key,"
            " CASE WHEN month_key >= 199901 THEN 'feed' END AS source FROM keyed",
            KEYED,
        ),
        "rewritten_layout": _suppliers(
            "SELECT symbol, date_key, volume, month_key,"
            " CASE WHEN month_key >= 199901 THEN 'feed' END AS source,"
            " 1 AS runs_that_moved, FALSE AS old_folder_left FROM keyed",
            KEYED,
        ),
        "described_fact": """
            SELECT CAST(position AS INTEGER) AS position, col_name, data_type,
                   CASE WHEN col_name IN ('daily_return', 'price_range', 'open_key', 'close_key', 'tick_count',
                                          'price_quantity', 'price_sum', 'batch_id') THEN 1.0 ELSE 0.0 END::DOUBLE AS null_rate
            FROM (SELECT unnest(range(16)) AS position, unnest(['symbol', 'date_key', 'open_price', 'high_price',
                    'low_price', 'close_price', 'volume', 'daily_return', 'price_range', 'volume_exact', 'open_key',
                    'close_key', 'tick_count', 'price_quantity', 'price_sum', 'batch_id']) AS col_name,
                  unnest(['string', 'int', 'double', 'double', 'double', 'double', 'bigint', 'double', 'double',
                    'double', 'decimal(38,0)', 'decimal(38,0)', 'bigint', 'double', 'double', 'bigint']) AS data_type
                  UNION ALL SELECT 16, 'month_key', 'int') WHERE (SELECT count(*) FROM lineitem) > 0""",
        "seeded_assets": (
            "SELECT 'P' || p_partkey AS symbol, p_name AS name, lower(p_type) AS asset_type,"
            " 'USD' AS currency FROM part"
        ),
        "hot_indicators": _sql("SELECT * FROM windows", TICKS, WINDOWS),
        "hot_indicators_stream": _sql("SELECT * FROM windows", TICKS, WINDOWS),
        "late_windows": _sql(
            "SELECT *, TRUE AS late_ticks_noticed FROM windows",
            TICKS.replace("FROM events)", "FROM events WHERE NOT (day(ts) < 15 AND event_id % 20 = 0))"),
            WINDOWS,
        ),
        "settled_indicators_stream": _sql(
            """SELECT * FROM windows
               WHERE window_end <= (SELECT make_timestamp((max(trade_time) - 600000) * 1000) FROM ticks)""",
            TICKS,
            WINDOWS,
        ),
        "daily_vwap": _sql(
            "SELECT symbol, fetch_date, steady(CASE WHEN sum(quantity) > 0 THEN"
            " sum(price * quantity) / sum(quantity) ELSE avg(price) END, 6) AS vwap"
            " FROM ticks GROUP BY symbol, fetch_date",
            TICKS,
        ),
        "feed_gaps": _sql(
            "SELECT symbol, make_timestamp(trade_time * 1000) AS gap_start,"
            " make_timestamp(n * 1000) AS gap_end, (n - trade_time) / 1000.0::DOUBLE AS gap_seconds"
            " FROM (SELECT *, lead(trade_time) OVER (PARTITION BY symbol ORDER BY trade_time, seq) AS n"
            " FROM ticks) WHERE n - trade_time > 120000",
            TICKS,
        ),
        "stale_feeds_stream": (
            "SELECT 'U' || user_id AS symbol, max(ts) AS last_event,"
            " CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts))) AS BIGINT) AS silent_seconds"
            " FROM events GROUP BY user_id"
            " HAVING epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts))) > 3600"
        ),
        # Events whose slot is closed when the stream ends; the newest of a user is silent once the clock
        # has passed it by threshold and slot.
        "silence_alerts": """
            WITH e AS (SELECT 'U' || user_id AS symbol, epoch_us(ts) // 1000 AS ms FROM events),
            closed AS (SELECT * FROM e WHERE (ms // 21600000 + 1) * 21600000 <= (SELECT max(ms) FROM e)),
            n AS (SELECT *, lead(ms) OVER (PARTITION BY symbol ORDER BY ms) AS following FROM closed)
            SELECT symbol, make_timestamp(ms * 1000) AS last_event, make_timestamp((ms + 21600000) * 1000) AS silent_after
            FROM n WHERE following - ms > 21600000
               OR (following IS NULL AND ms + 2 * 21600000 <= (SELECT max(ms) FROM e))""",
        "sma": _suppliers(
            "SELECT symbol, fetch_date, "
            + _named({f"sma_{n}": f"steady({_mean('close_price', n)}, 6)" for n in (5, 10, 20)})
            + " FROM sbars"
        ),
        "lags": _events(f"SELECT symbol, fetch_date, {_named(_LAGS)} FROM bars"),
        "volatility": _suppliers(
            "SELECT symbol, fetch_date, steady(r1, 6) AS return_1, steady(r4, 6) AS return_4,"
            " steady(r24, 6) AS return_24, steady(CASE WHEN count(r1)"
            f" {_TIED} ROWS 19 PRECEDING) = 20 THEN stddev_samp(r1) {_TIED} ROWS 19 PRECEDING) END, 6)"
            f" AS volatility_20 FROM (SELECT *, {_step(1)} AS r1, {_step(4)} AS r4, {_step(24)} AS r24"
            " FROM sbars)"
        ),
        "price_ratios": _events(
            f"SELECT symbol, fetch_date, steady(close_price / ({_mean('close_price', 5)}), 6)"
            " AS price_sma_5_ratio, steady(close_price / vwap, 6) AS price_vwap_ratio"
            " FROM bars JOIN (SELECT symbol, fetch_date, CASE WHEN sum(quantity) > 0 THEN"
            " sum(price * quantity) / sum(quantity) ELSE avg(price) END AS vwap FROM ticks"
            " GROUP BY symbol, fetch_date) USING (symbol, fetch_date)"
        ),
        "rsi": _suppliers(
            "SELECT symbol, fetch_date, steady(rsi_value, 6) AS rsi_14, CASE WHEN rsi_value >= 70"
            " THEN -1 WHEN rsi_value <= 30 THEN 1 WHEN rsi_value IS NOT NULL THEN 0 END AS rsi_signal"
            " FROM strength",
            _moves("sbars"),
        ),
        "ema": _sql(
            "SELECT a.symbol, a.fetch_date, steady(a.e, 6) AS ema_5, steady(b.e, 6) AS ema_20"
            " FROM ema5 a JOIN ema20 b USING (symbol, i)",
            SUPPLIER_TICKS,
            SUPPLIER_BARS,
            f"numbered AS (SELECT *, row_number() {_TIED}) AS i FROM sbars)",
            _ema(5),
            _ema(20),
            recursive=True,
        ),
        "volume_anomaly": _suppliers(
            "SELECT symbol, fetch_date, steady(z, 6) AS volume_z, COALESCE(abs(z) > 3, false)"
            " AS is_abnormal FROM (SELECT *, CASE WHEN n = 20 AND s > 0 THEN (x - m) / s END AS z"
            " FROM (SELECT *, count(x) OVER w AS n, avg(x) OVER w AS m, stddev_samp(x) OVER w AS s"
            " FROM (SELECT symbol, fetch_date, ln(1 + volume) AS x FROM sbars) WINDOW w AS"
            " (PARTITION BY symbol ORDER BY fetch_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)))"
        ),
        "volume_ranks": _suppliers(
            "SELECT symbol, fetch_date, CAST(row_number() OVER (PARTITION BY symbol"
            " ORDER BY volume DESC, fetch_date) AS INTEGER) AS row_number,"
            " CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER)"
            " AS dense_rank FROM sbars WINDOW w AS (PARTITION BY symbol ORDER BY volume DESC)"
        ),
        "panel_prices": _events(
            'SELECT CAST(fetch_date AS TIMESTAMP) AS time, close_price AS "Close Price", symbol'
            " FROM gold ORDER BY time, symbol",
            RETURNS,
            ASSETS,
            GOLD,
        ),
        "panel_volume": _events(
            'SELECT CAST(fetch_date AS TIMESTAMP) AS time, volume AS "Volume",'
            " steady(CASE WHEN volume > 0 THEN log10(volume) END, 6) AS log10_volume, symbol"
            " FROM gold ORDER BY time, symbol",
            RETURNS,
            ASSETS,
            GOLD,
        ),
        "panel_latest": _events(
            'SELECT symbol AS "Symbol", fetch_date AS "Date", open_price AS "Open",'
            ' high_price AS "High", low_price AS "Low", close_price AS "Close", volume AS "Volume",'
            ' currency AS "Currency", asset_type AS "Asset Type" FROM gold'
            " ORDER BY fetch_date DESC, symbol LIMIT 100",
            RETURNS,
            ASSETS,
            GOLD,
        ),
        "latest_indicators": _sql(
            "SELECT * FROM windows ORDER BY window_start DESC, symbol LIMIT 50", TICKS, WINDOWS
        ),
        "preview": _suppliers(
            "SELECT symbol, fetch_date, volume FROM sbars WHERE volume > 0"
            " ORDER BY fetch_date, symbol LIMIT 5"
        ),
        "symbol_history": _events(
            "SELECT symbol, fetch_date, close_price, volume FROM bars WHERE symbol = 'click'"
            " AND fetch_date >= DATE '2024-01-30' - 10"
        ),
        "weekly_prices": _suppliers("SELECT * FROM periods", _PERIODS.format(period="week")),
        "monthly_prices": _suppliers("SELECT * FROM periods", _PERIODS.format(period="month")),
        "volume_rollup": _suppliers(
            "SELECT symbol, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,"
            " CAST(sum(volume) AS BIGINT) AS volume, count(*) AS bars,"
            " CAST(grouping_id(symbol, y, m) AS INTEGER) AS level FROM (SELECT *,"
            " year(fetch_date) AS y, month(fetch_date) AS m FROM sbars) GROUP BY ROLLUP (symbol, y, m)"
        ),
        "cumulative_volume": _suppliers(
            "SELECT symbol, month_start, CAST(v AS BIGINT) AS volume, CAST(sum(v) OVER"
            " (PARTITION BY symbol ORDER BY month_start) AS BIGINT) AS cumulative_volume FROM"
            " (SELECT symbol, CAST(date_trunc('month', fetch_date) AS DATE) AS month_start,"
            " sum(volume) AS v FROM sbars GROUP BY 1, 2)"
        ),
        "market_summary": _suppliers(
            "SELECT fetch_date, count(*) AS symbols, CAST(sum(volume) AS BIGINT) AS total_volume,"
            " steady(avg(daily_return), 4) AS mean_return,"
            " arg_max(symbol, (daily_return, symbol)) AS best_symbol,"
            " arg_min(symbol, (daily_return, symbol)) AS worst_symbol FROM srets GROUP BY fetch_date",
            SUPPLIER_RETURNS,
        ),
        "ml_features": _suppliers(
            "SELECT symbol, fetch_date, steady(close_price, 6) AS close_price, "
            + _named({f"sma_{n}": f"steady({_mean('close_price', n)}, 6)" for n in (5, 10, 20)})
            + f", steady(lag(close_price) {_TIED}), 6) AS close_lag_1,"
            f" lag(volume) {_TIED}) AS volume_lag_1,"
            f" steady(lag(daily_return) {_TIED}), 6) AS return_lag_1,"
            f" steady({_step(1)}, 6) AS return_1, steady({_step(4)}, 6) AS return_4,"
            f" steady(close_price / ({_mean('close_price', 20)}), 6) AS price_sma_20_ratio,"
            f" steady(rsi_value, 6) AS rsi_14, CASE WHEN lead(close_price) {_TIED}) IS NOT NULL THEN"
            f" CAST(lead(close_price) {_TIED}) > close_price AS INTEGER) END AS target FROM strength",
            SUPPLIER_RETURNS,
            _moves("srets"),
        ),
        "ml_split": _suppliers(
            "SELECT symbol, fetch_date, CASE WHEN fetch_date <= (SELECT quantile_disc(d, 0.8) FROM"
            " (SELECT DISTINCT fetch_date AS d FROM sbars)) THEN 'train' ELSE 'test' END AS split"
            " FROM sbars"
        ),
        "direction_model": _suppliers(
            "SELECT symbol, fetch_date + 1 AS prediction_date, 'v1' AS model_version,"
            " true AS direction_agrees, (SELECT count(*) FROM learnable WHERE split = 'test' AND more)"
            " AS n_scored, true AS has_accuracy FROM learnable WHERE split = 'test'"
            " AND fetch_date BETWEEN DATE '2000-01-01' AND DATE '2050-12-30'",
            LEARNABLE,
        ),
        **{
            f"{name}_model": _suppliers(
                f"SELECT '{label}' AS label, count(*) FILTER (split = 'train') AS n_train,"
                " count(*) FILTER (split = 'test') AS n_test, true AS errors_are_ordered"
                " FROM learnable WHERE more",
                LEARNABLE,
            )
            for name, label in (("volatility", "next_range"), ("close", "next_close"))
        },
        # Forecast and outcome are columns of one row, so no join is needed.
        "forecast_vs_actual": _suppliers(
            "SELECT CAST(fetch_date AS TIMESTAMP) AS time, symbol, CASE WHEN r > 0 THEN 1 ELSE 0 END AS"
            " predicted_direction, CASE WHEN r > 0 THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS probability,"
            " steady(close_price, 6) AS actual_close,"
            " CASE WHEN close_price > prev_close THEN 1 ELSE 0 END AS actual_direction"
            f" FROM (SELECT *, lag(daily_return) {_TIED}) AS r FROM srets) WHERE day(fetch_date) % 5 <> 0",
            SUPPLIER_RETURNS,
        ),
        "forecast_vs_actual_panel": _suppliers(
            "SELECT CAST(fetch_date AS TIMESTAMP) AS time, symbol, predicted_direction, probability,"
            f" steady(close_price, 6) AS actual_close, CASE WHEN close_price > lag(close_price) {_TIED})"
            " THEN 1 ELSE 0 END AS actual_direction FROM predictions JOIN"
            " (SELECT symbol, fetch_date, close_price FROM sbars) USING (symbol, fetch_date)",
            SUPPLIER_RETURNS,
            PREDICTIONS,
        ),
        "losing_streaks": _suppliers(
            "SELECT symbol, min(time) AS first_day, max(time) AS last_day, count(*) AS days_wrong"
            " FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time) - row_number()"
            " OVER (PARTITION BY symbol, wrong ORDER BY time) AS island FROM (SELECT *,"
            " predicted_direction <> actual_direction AS wrong FROM compared)) WHERE wrong"
            " GROUP BY symbol, island HAVING count(*) > 3",
            SUPPLIER_RETURNS,
            PREDICTIONS,
            COMPARED,
        ),
        "direction_metrics": _suppliers(
            "SELECT n, steady(hits / n, 6) AS accuracy, steady(tp / (tp + fp), 6) AS precision,"
            " steady(tp / (tp + fn), 6) AS recall, steady(2 * tp / (2 * tp + fp + fn), 6) AS f1_score"
            " FROM (SELECT count(*) AS n,"
            " count(*) FILTER (WHERE predicted_direction = 1 AND actual_direction = 1) AS tp,"
            " count(*) FILTER (WHERE predicted_direction = 1 AND actual_direction = 0) AS fp,"
            " count(*) FILTER (WHERE predicted_direction = 0 AND actual_direction = 1) AS fn,"
            " count(*) FILTER (WHERE predicted_direction = actual_direction) AS hits FROM compared)",
            SUPPLIER_RETURNS,
            PREDICTIONS,
            COMPARED,
        ),
        "regression_metrics": _suppliers(
            "SELECT count(e) AS n, steady(sqrt(avg(e * e)), 4) AS rmse, steady(avg(abs(e)), 4) AS mae"
            f" FROM (SELECT close_price - lead(close_price) {_TIED}) AS e FROM sbars)"
        ),
        "load_accounting": f"""
            WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS fetch_date, o_orderkey % 2 AS batch FROM orders),
            b AS (SELECT DISTINCT *, {IN_DIM} AS dated FROM o),
            f AS (SELECT DISTINCT o_custkey, fetch_date, o_custkey % 3 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer)
                  AS listed FROM b WHERE dated)
            SELECT 'silver' AS step, batch AS batch_id, 'no_date' AS reason, count(*) AS total_bars,
                   count(*) FILTER (NOT dated) AS dropped_bars,
                   count(DISTINCT o_custkey) FILTER (NOT dated) AS dropped_symbols FROM b GROUP BY batch
            UNION ALL SELECT 'gold', 1, 'no_asset', count(*), count(*) FILTER (NOT listed),
                   count(DISTINCT o_custkey) FILTER (NOT listed) FROM f
            UNION ALL SELECT 'gold', 1, 'no_date', count(*), 0, 0 FROM f""",
        "catalog_fact": _events(FACT_SELECT, RETURNS),
        "stored_vwap": _sql(
            f"SELECT symbol, {DATE_KEY} AS date_key, steady(CASE WHEN sum(quantity) > 0 THEN"
            " sum(price * quantity) / sum(quantity) ELSE avg(price) END, 6) AS vwap"
            " FROM ticks GROUP BY symbol, fetch_date",
            TICKS,
        ),
        "redelivered_fact": _events(FACT_SELECT, RETURNS),
        "offset_intervals": _sql(
            """SELECT topic, partition, min(seq) AS first_offset, max(seq) AS last_offset FROM (
                 SELECT *, sum(new) OVER (PARTITION BY topic, partition ORDER BY seq) AS island FROM (
                   SELECT topic, partition, seq, CASE WHEN lag(seq) OVER (PARTITION BY topic, partition ORDER BY seq) = seq - 1
                          THEN 0 ELSE 1 END AS new
                   FROM broken WHERE seq % 97 <> 0 AND seq % 1000 < 900))
               GROUP BY topic, partition, island""",
            TICKS,
            BROKEN,
        ),
        "stored_dead_letters": _sql(
            "SELECT reason, topic, count(*) AS messages FROM ("
            " SELECT reason, topic FROM broken WHERE reason IS NOT NULL UNION ALL"
            " SELECT 'unknown_topic', 'unlisted' FROM broken WHERE seq % 5 = 0) GROUP BY ALL",
            TICKS,
            BROKEN,
        ),
        "cold_path_gold": _sql(
            "SELECT * FROM gold",
            TICKS,
            BROKEN,
            _BARS.format(
                name="bars",
                order="(trade_time, topic, partition, seq)",
                source="(SELECT * FROM broken WHERE reason IS NULL)",
            ),
            RETURNS,
            ASSETS,
            GOLD,
        ),
    }
