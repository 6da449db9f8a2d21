import json

from helpers import random_ticks, ticks
from test_streaming import envelopes

from barlake.plans import cold_path, jobs


def test_jobs_end_to_end(spark, folder, capsys):
    config = {"symbols": [{"symbol": s, "name": s, "type": "stock"} for s in "AB"]}
    with open(f"{folder}/symbols.json", "w") as out:
        json.dump(config, out)
    envelopes(ticks(spark, random_ticks(21, 1200, days=60))).write.json(f"{folder}/broker")
    root, broker = f"{folder}/lake", f"{folder}/broker"
    jobs.main(["setup", "--root", root, "--symbols", f"{folder}/symbols.json"], spark)
    jobs.main(["cold-path", "--root", root, "--messages", broker], spark)
    jobs.main(["hot-path", "--root", root, "--messages", broker, "--drain"], spark)
    jobs.main(["maintain", "--root", root], spark)
    lake = cold_path.Lake(root)
    bars = spark.read.parquet(lake.gold).count()
    assert bars > 100
    for version in ("v1", "v2"):
        jobs.main(["predict", "--root", root, "--model-version", version], spark)
    predicted = spark.read.parquet(lake.predictions).collect()
    assert sorted((r.symbol, r.model_version) for r in predicted) == [(s, "v2") for s in "ABC"]
    metrics = spark.read.json(f"{lake.models}/v2/metrics").first()
    assert metrics["n"] > 0 and 0 <= metrics["accuracy"] <= 1
    assert spark.read.parquet(lake.indicators).count() > 0
    assert "Exception" not in capsys.readouterr().out


def test_tables_of_the_catalog_and_alerts(spark, folder):
    config = {"symbols": [{"symbol": s, "name": s, "type": "stock"} for s in "AB"]}
    with open(f"{folder}/symbols.json", "w") as out:
        json.dump(config, out)
    root, broker, database = f"{folder}/lake", f"{folder}/broker", "jobs_star"
    envelopes(ticks(spark, random_ticks(22, 200))).write.json(broker)
    common = ["--root", root, "--database", database]
    try:
        for _ in range(2):
            jobs.main(["setup", *common, "--symbols", f"{folder}/symbols.json"], spark)
        jobs.main(["cold-path", *common, "--messages", broker], spark)
        lake = cold_path.Lake(root)
        fact = spark.read.parquet(lake.fact).count()
        assert spark.table(f"{database}.fact_daily_prices").count() == fact > 0
        assert spark.table(f"{database}.dim_assets").count() == 2
        assert spark.table(f"{database}.dim_date").filter("year = 2024").count() == 366
        jobs.main(["maintain", *common], spark)
        jobs.main(["freshness", *common, "--messages", broker, "--drain"], spark)
        assert spark.read.parquet(lake.alerts).count() > 0
        jobs.main(["hot-path", *common, "--messages", broker, "--drain", "--settled"], spark)
        assert spark.read.parquet(lake.settled_indicators).count() > 0
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {database} CASCADE")


def test_password_comes_from_a_file(tmp_path):
    (tmp_path / "secret").write_text("pw\n")
    arguments = ["setup", "--root", "r", "--jdbc-url", "u", "--jdbc-user", "me"]
    options = jobs.parser().parse_args([*arguments, "--jdbc-password-file", str(tmp_path / "secret")])
    database = jobs._database(options)
    assert (database.user, database.password) == ("me", "pw") and "pw" not in repr(database)
