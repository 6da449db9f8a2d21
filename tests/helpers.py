"""Literal inputs and small assertions."""

import random
from datetime import date

DAY_MS = 86_400_000
BASE_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z

TICK_DDL = "symbol STRING, price DOUBLE, quantity DOUBLE, trade_time BIGINT, seq BIGINT"


def ticks(spark, rows):
    """Rows are ``(symbol, price, quantity, ms since 2024-01-01, seq)``."""
    return spark.createDataFrame([(s, p, q, BASE_MS + t, n) for s, p, q, t, n in rows], TICK_DDL)


def random_ticks(seed, count=300, days=6, symbols=("A", "B", "C")):
    rng = random.Random(seed)
    return [
        (
            rng.choice(symbols),
            float(rng.randint(1, 50)),
            float(rng.randint(0, 9)),
            rng.randrange(days) * DAY_MS + rng.randrange(5) * 60_000,
            n,
        )
        for n in range(count)
    ]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def day(n):
    return date(2024, 1, n)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
