import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import resample

BARS = "symbol string, timestamp bigint, open double, high double, low double, close double, volume double"


def random_bars(spark, n=400):
    rng = random.Random(2)
    rows = []
    for t in rng.sample(range(5 * 86400), n):
        low, high = sorted(round(rng.uniform(1, 99), 2) for _ in range(2))
        rows.append((rng.choice("AB"), t, round(rng.uniform(low, high), 2), high, low, round(rng.uniform(low, high), 2), float(rng.randrange(9))))
    return spark.createDataFrame(rows, BARS)


def day():
    return F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int"))


def test_daily_bars_equal_the_join_form(spark, rows_of):
    df = random_bars(spark)
    columns = ["symbol", "date", "daily_open", "daily_high", "daily_low", "daily_close", "daily_volume", "cnt"]
    once = resample.daily_bars(df, day(), ["timestamp"], scale=2)
    assert rows_of(once, *columns) == rows_of(resample.daily_bars_by_join(df, day(), scale=2), *columns)
    assert once.filter("daily_low > least(daily_open, daily_close) or daily_high < greatest(daily_open, daily_close)").count() == 0
    assert once.agg(F.sum("cnt")).first()[0] == df.count()


def test_plain_order_stays_a_hash_aggregate(spark):
    plan = lambda order: resample.daily_bars(random_bars(spark), day(), order)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan(["timestamp"]) and "partial_min_by" in plan(["timestamp"])
    assert "Exchange hashpartitioning" in plan(["timestamp"]) and plan(["timestamp"]).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(("mode", "volume", "trades"), [("sum", 330.0, 33), ("last", 120.0, 12)])
def test_ticks_out_of_order_and_volume_modes(spark, mode, volume, trades):
    rows = [("A", t, float(p), float(v), v // 10) for t, p, v in [(3, 30, 120), (1, 10, 100), (2, 20, 110)]]
    df = spark.createDataFrame(rows, "symbol string, t int, price double, volume double, number_trades int")
    df = df.select(
        "*", F.timestamp_seconds("t").alias("event_timestamp"), F.to_date(F.timestamp_seconds("t")).alias("date"),
        *[F.col("price").alias(c) for c in ("open", "high", "low")], F.col("volume").alias("quote_volume"),
    )
    row = resample.daily_ticks(df.repartition(3), volume_mode=mode).first()
    assert (row.daily_open, row.daily_close, row.daily_high, row.daily_low) == (10.0, 30.0, 30.0, 10.0)
    assert (row.daily_volume, row.total_trades, row.tick_count, row.avg_price) == (volume, trades, 3, 20.0)
    with pytest.raises(ValueError):
        resample.daily_ticks(df, volume_mode="first")
