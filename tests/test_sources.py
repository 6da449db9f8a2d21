import json
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from barlake import schemas
from barlake.sources import dimensions, jdbc, messages, tables, vendors

SYMBOLS = [("BTC-USD", "Bitcoin", "crypto"), ("AAPL", "Apple", "stock")]


def envelopes(spark, values, key="AAPL", at=datetime(2024, 1, 1)):
    data = [(key, v, "t", 0, i, at) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.ENVELOPE_DDL)


@pytest.fixture
def assets(spark, tmp_path):
    config = {"symbols": [{"symbol": s, "name": n, "type": t} for s, n, t in SYMBOLS]}
    path = tmp_path / "symbols.json"
    path.write_text(json.dumps(config, indent=2))
    return dimensions.read_symbols(spark, str(path))


def test_symbols_config(assets):
    assert rows(assets) == [
        ("AAPL", "Apple", "stock", "USD"),
        ("BTC-USD", "Bitcoin", "crypto", "USD"),
    ]
    assert rows(dimensions.symbols_of_type(assets, "stock")) == [("AAPL",)]
    assert rows(vendors.stream_names(assets)) == [("btcusdt@trade",)]


def test_dim_date(spark, folder):
    dim = dimensions.generate_dim_date(spark)
    assert dim.count() == 18_628
    first = tuple(dim.filter("date_key = 20000101").first())
    assert first == (20000101, "2000-01-01", 2000, 1, 1, 1, 6, "Saturday", "January", 1)
    dimensions.export_csv(dim, f"{folder}/csv")
    back = dimensions.read_dim_date_csv(spark, f"{folder}/csv")
    assert back.schema.simpleString() == dim.schema.simpleString()
    assert back.exceptAll(dim).count() == 0


def test_crypto_payloads(spark, assets):
    trade = {"s": "BTCUSDT", "p": "95000.5", "q": "0.5", "T": 1700000000000}
    values = [
        json.dumps({"stream": "btcusdt@trade", "data": trade}),
        json.dumps(trade),
        json.dumps({**trade, "s": "DOGEUSDT"}),
        json.dumps({**trade, "p": "n/a"}),
        "{",
    ]
    got = vendors.crypto_ticks(envelopes(spark, values), vendors.crypto_aliases(assets))
    assert rows(got) == [
        ("BTC-USD", None, 0.5, 1700000000000),
        ("BTC-USD", 95000.5, 0.5, 1700000000000),
        ("BTC-USD", 95000.5, 0.5, 1700000000000),
    ]


def test_stock_payloads(spark):
    def chart(**meta):
        return json.dumps({"chart": {"result": [{"meta": meta}]}})

    values = [
        chart(regularMarketPrice=190.1, regularMarketTime=1700000000),
        chart(regularMarketPrice=5.0),
        chart(regularMarketTime=1700000000),
        '{"chart":{"result":[]}}',
        '{"chart":{"result":null}}',
        "{}",
    ]
    got = vendors.stock_ticks(envelopes(spark, values))
    assert rows(got) == [
        ("AAPL", 5.0, 1.0, 1704067200000),
        ("AAPL", 190.1, 1.0, 1700000000000),
    ]


def test_daily_payloads(spark):
    metadata = {
        "symbol": "AAPL",
        "name": "Apple",
        "asset_type": "stock",
        "fetch_timestamp": "2024-01-01T05:00:00",
    }
    chart = {"meta": {"regularMarketPrice": 190.5, "regularMarketTime": 1700000000}}
    values = [
        json.dumps({"metadata": metadata, "raw_data": chart}),
        json.dumps({"metadata": metadata, "raw_data": {}}),
        json.dumps({"metadata": metadata}),
    ]
    got = vendors.daily_quote(vendors.daily_payloads(envelopes(spark, values)))
    assert [(r.symbol, r.price, r.trade_time) for r in got.collect()] == [
        ("AAPL", 190.5, 1700000000000)
    ]


def test_encoded_messages_parse_back(spark):
    sent = messages.sample_ticks(spark, 1700000000000)
    encoded = messages.encode_ticks(sent)
    parsed = messages.parse_ticks(encoded, keep=())
    assert sent.count() == 10 and parsed.exceptAll(sent).count() == 0


def test_seeding_is_idempotent(spark, assets, folder):
    for _ in range(2):
        tables.seed(assets, f"{folder}/a", schemas.DIM_ASSETS_DDL, ["symbol"], ["asset_type"])
    assert spark.read.parquet(f"{folder}/a").count() == 2


def test_star_schema_in_the_catalog(spark, assets, folder):
    for _ in range(2):
        tables.create_star_schema(spark, "trading_test", folder)
    tables.append_table(
        assets.select("symbol", "name", "currency", "asset_type"),
        "trading_test.dim_assets",
        ["asset_type"],
    )
    assert tables.read_table(spark, "trading_test.dim_assets").count() == 2
    described = tables.describe(tables.read_table(spark, "trading_test.fact_daily_prices"))
    assert ("close_price", "double") in {(r.col_name, r.data_type) for r in described.collect()}
    assert tables.read_table(spark, "trading_test.fact_daily_prices").count() == 0


def test_postgres_statement():
    sql = jdbc.upsert_statement("postgresql", "t", "s", ["k", "d", "v"], ["k", "d"])
    assert sql == (
        'INSERT INTO t ("k", "d", "v") SELECT "k", "d", "v" FROM s'
        ' ON CONFLICT ("k", "d") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert jdbc.upsert_statement("postgresql", "t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_serving_tables_have_their_key():
    assert jdbc.create_statement("crypto_indicators").endswith(
        'PRIMARY KEY ("symbol", "window_start"))'
    )
    for name, (columns, keys) in jdbc.SERVING_TABLES.items():
        assert set(keys) < {c for c, _ in columns}, name


def test_merge_statement():
    sql = jdbc.upsert_statement("derby", "t", "s", ["k", "v"], ["k"])
    assert sql == (
        'MERGE INTO t t USING s s ON t."k" = s."k" WHEN MATCHED THEN UPDATE SET "v" = s."v"'
        ' WHEN NOT MATCHED THEN INSERT ("k", "v") VALUES (s."k", s."v")'
    )
    with pytest.raises(ValueError):
        jdbc.upsert_statement("other", "t", "s", ["k"], ["k"])


def test_upsert_drops_its_staging_table_even_on_failure(spark, monkeypatch):
    calls = []

    def run(session, target, statements):
        calls.append(statements)
        if len(calls) == 1:
            raise RuntimeError("merge failed")

    monkeypatch.setattr(jdbc, "overwrite_jdbc", lambda df, target, table: None)
    monkeypatch.setattr(jdbc, "run_in_transaction", run)
    target = jdbc.JdbcTarget("jdbc:x", "d", user="u", password="secret")
    with pytest.raises(RuntimeError, match="merge failed"):
        jdbc.upsert_jdbc(spark.range(1), target, "daily_prices", ["id"])
    assert calls[0][1] == calls[1][0] and calls[1][0].startswith("DROP TABLE daily_prices_staging_")
    assert "secret" not in repr(target)


def test_table_append_is_partitioned(spark, folder):
    tables.append(spark.range(4).withColumn("p", F.col("id") % 2), f"{folder}/t", ["p"])
    tables.append(spark.range(2).withColumn("p", F.col("id") % 2), f"{folder}/t", ["p"])
    assert spark.read.parquet(f"{folder}/t").groupBy("p").count().orderBy("p").collect() == [
        (0, 3),
        (1, 3),
    ]


def test_scratch_scope_removes_all_but_what_is_kept(spark):
    from barlake import storage

    kept = []
    with storage.scratch_scope(spark, lambda: kept):
        for name in ("a", "b"):
            spark.range(1).write.parquet(path := storage.scratch_path(spark, name))
            kept[:] = [path]
        with storage.scratch_scope(spark):
            spark.range(1).write.parquet(inner := storage.scratch_path(spark, "c"))
        assert not storage.path_exists(spark, inner)
    assert storage.path_exists(spark, kept[0])
    outside = storage.scratch_path(spark, "d")
    assert outside not in kept and storage._SCOPES == []
