import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import calendar, fill, reports

DAILY = "symbol string, date date, daily_open double, daily_high double, daily_low double, daily_close double, daily_volume double, cnt bigint"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def daily(spark, closes, symbol="A"):
    rows = [(symbol, day(d), c, c, c, c, 10.0 * c if c is not None else None, 1) for d, c in closes]
    return spark.createDataFrame(rows, DAILY)


@pytest.mark.parametrize(("policy", "volume"), [("zero", 0.0), ("carry", 10.0)])
def test_a_hole_is_filled_and_marked(spark, policy, volume):
    rows = calendar.fill_calendar(daily(spark, [(0, 1.0), (2, 3.0)]), policy).orderBy("date").collect()
    assert [r.daily_close for r in rows] == [1.0, 1.0, 3.0]
    assert [r.is_filled for r in rows] == [False, True, False]
    assert rows[1].daily_volume == volume and rows[1].cnt == 0


def test_null_prices_take_the_last_known_and_a_null_head_is_dropped(spark):
    rows = calendar.fill_calendar(daily(spark, [(0, None), (1, 2.0), (3, None), (4, 5.0)])).orderBy("date").collect()
    assert [(r.date, r.daily_close) for r in rows] == [(day(1), 2.0), (day(2), 2.0), (day(3), 2.0), (day(4), 5.0)]


def test_until_extends_and_cuts(spark):
    df = daily(spark, [(0, 1.0), (2, 3.0), (9, 9.0)])
    rows = calendar.fill_calendar(df, until=F.lit(day(4))).orderBy("date").collect()
    assert [(r.date, r.daily_close) for r in rows] == [(day(i), c) for i, c in enumerate([1.0, 1.0, 3.0, 3.0, 3.0])]


def test_dense_length_and_join_form(spark, rows_of):
    rng = random.Random(5)
    closes = {s: [(d, float(rng.randrange(50))) for d in sorted(rng.sample(range(400), 60))] for s in "ABC"}
    df = None
    for s, c in closes.items():
        df = daily(spark, c, s) if df is None else df.unionByName(daily(spark, c, s))
    filled = calendar.fill_calendar(df)
    for r in filled.groupBy("symbol").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b")).collect():
        assert r.n == (r.b - r.a).days + 1
    window = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    joined = calendar.calendar_spine(df).join(df, ["symbol", "date"], "left")
    joined = joined.withColumn("daily_close", F.last("daily_close", True).over(window))
    assert rows_of(filled, "symbol", "date", "daily_close") == rows_of(joined, "symbol", "date", "daily_close")


def test_calendar_needs_two_shuffles_at_most(spark):
    df = daily(spark, [(0, 1.0), (2, 3.0)]).groupBy("symbol", "date").agg(*[F.max(c).alias(c) for c in calendar.DAILY_OHLC], F.max("daily_volume").alias("daily_volume"))
    plan = calendar.moving_averages(calendar.fill_calendar(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_moving_average_heads(spark):
    df = daily(spark, [(i, float(i + 1)) for i in range(10)])
    partial = calendar.moving_averages(df).orderBy("date").collect()
    assert partial[0].ma7 == 1.0 and partial[9].ma7 == 7.0 and partial[9].ma30 == 5.5
    strict = calendar.moving_averages(df, min_periods=7).orderBy("date").collect()
    assert [r.ma7 for r in strict[:7]] == [None] * 6 + [4.0]
    exact = calendar.moving_averages(df, windows=[1], scale=2).collect()
    assert all(r.ma1 == r.daily_close for r in exact)


def test_two_level_fill_equals_one_window(spark, rows_of):
    rng = random.Random(11)
    stamps = {(("A" if rng.random() < 0.7 else "B"), rng.randrange(0, 40) * 86400 // 4 + rng.randrange(5)) for _ in range(400)}
    rows = [(s, t, *(float(rng.randrange(9)) if rng.random() < 0.2 else None for _ in range(2))) for s, t in sorted(stamps)]
    rows += [(None, 5, 1.0, None), (None, 90000, None, None)]
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, x double, y double")
    window = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumns({c: F.last(c, True).over(window) for c in "xy"})
    assert rows_of(fill.forward_fill(df, ["x", "y"])) == rows_of(plain)
    hourly = F.floor(F.col("timestamp") / 3600)
    assert rows_of(fill.forward_fill(df, ["x", "y"], segment=hourly)) == rows_of(plain)


def test_cleaning_deduplicates_before_it_fills(spark, rows_of):
    rows = [("A", 0, None), ("A", 60, 5.0), ("A", 60, None), ("A", 120, None), ("A", 120, 9.0)]
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, p double")
    bars = df.select("symbol", "timestamp", *[F.col("p").alias(c) for c in ("open", "high", "low", "close", "volume")])
    clean = fill.clean_bars(bars, [F.col("close").asc_nulls_last()])
    assert rows_of(clean, "timestamp", "close") == [(60, 5.0), (120, 9.0)]


def test_reports(spark):
    df = daily(spark, [(0, 1.0), (1, 2.0), (40, 2.0)]).withColumn("daily_open", F.lit(1.0))
    df = df.unionByName(daily(spark, [(0, 0.0)], "Z"))
    top = reports.top_price_change_days(df, 3).collect()
    assert [(r.symbol, r.date, r.price_change_percent) for r in top[:2]] == [("A", day(1), 100.0), ("A", day(40), 100.0)]
    everything = reports.top_price_change_days(df).collect()
    assert everything[-1].symbol == "Z" and everything[-1].price_change_percent is None
    assert [r.daily_volume for r in reports.top_volume_days(df, 2).collect()] == [20.0, 20.0]
    months = {(r.symbol, r.month): r.avg_volume for r in reports.avg_volume_per_month(df).collect()}
    assert months["A", "2024-01"] == 15.0 and months["A", "2024-02"] == 20.0
    years = {(r.symbol, r.year): r.avg_return for r in reports.avg_return_per_year(df).collect()}
    assert years["A", 2024] == pytest.approx(200 / 3) and years["Z", 2024] is None
    assert [r.date for r in reports.last_n(df.filter("symbol = 'A'"), 2).orderBy("date").collect()] == [day(1), day(40)]


def test_histogram_keeps_values_outside_the_range(spark, rows_of):
    df = spark.createDataFrame([("A", v) for v in (-1.0, 0.0, 4.9, 5.0, 10.0, 99.0)], "symbol string, pct_error double")
    assert rows_of(reports.error_histogram(df, 0, 10, 2)) == [("A", 0, 1), ("A", 1, 2), ("A", 2, 1), ("A", 3, 2)]
