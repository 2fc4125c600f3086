import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import calendar, quality

BARS = "symbol string, timestamp bigint, close double"


def random_bars(spark, n=600, seed=3, step=4000):
    # Series A holds most of the rows; B spans long empty stretches; stamps repeat.
    rng = random.Random(seed)
    rows = [("A" if rng.random() < 0.8 else "B", rng.randrange(0, 200) * step + rng.randrange(3), float(rng.randrange(9))) for _ in range(n)]
    return spark.createDataFrame(rows, BARS)


@pytest.mark.parametrize("partitions", [1, 2, 50])
def test_keep_first_is_independent_of_partitioning(spark, rows_of, partitions):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 1, 3.0), ("A", 1, 4.0), ("B", 1, 9.0)], BARS).repartition(partitions)
    once = quality.keep_first(df, ["symbol", "timestamp"], ["close"])
    assert rows_of(once) == [("A", 1, 3.0), ("B", 1, 9.0)]
    assert rows_of(quality.keep_first(once, ["symbol", "timestamp"], ["close"])) == rows_of(once)


def test_keep_first_limits_before_the_shuffle(spark):
    df = quality.keep_first(random_bars(spark), ["symbol", "timestamp"], ["close"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_gaps_equal_a_plain_lag(spark, rows_of):
    df = random_bars(spark)
    window = Window.partitionBy("symbol").orderBy("timestamp")
    plain = df.select("symbol", "timestamp").distinct().withColumn("prev_ts", F.lag("timestamp").over(window)).dropna()
    gaps = quality.time_gaps(df)
    assert rows_of(gaps, "symbol", "timestamp", "prev_ts") == rows_of(plain, "symbol", "timestamp", "prev_ts")
    assert rows_of(quality.time_gaps(df, segment_seconds=3600)) == rows_of(gaps)


def test_large_gaps_keep_the_ending_bar_and_break_ties(spark):
    rows = [("A", 0, 1.0), ("A", 100, 2.0), ("A", 100, 1.5), ("A", 130, 3.0), ("B", 0, 1.0), ("B", 100, 7.0)]
    top = quality.large_gaps(spark.createDataFrame(rows, BARS), threshold=60, top=1).collect()
    assert [(r.symbol, r.timestamp, r.prev_ts, r.gap, r.close) for r in top] == [("A", 100, 0, 100, 1.5)]


def test_duplicate_counts_and_coverage(spark, rows_of):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 1, 2.0), ("A", 2, 1.0)], BARS)
    assert rows_of(quality.duplicate_keys(df, ["symbol", "timestamp"])) == [("A", 1, 2)]
    assert rows_of(quality.coverage(df, date="timestamp")) == [("A", 3, 1, 2)]


def test_stage_audit_adds_up(spark):
    df = random_bars(spark).withColumn("close", F.when(F.col("close") > 2, F.col("close")))
    for r in quality.stage_audit(df, "symbol", "timestamp", ["close"]).collect():
        mine = df.filter(F.col("symbol") == r.symbol)
        assert r.rows_in == mine.count()
        assert r.rows_with_null == mine.filter("close is null").count()
        assert r.rows_unique == mine.select("timestamp").distinct().count() == r.rows_in - r.rows_repeated


def test_observation_counts_without_a_second_job(spark):
    df, seen = quality.observed(random_bars(spark, n=50).withColumn("close", F.when(F.col("close") > 4, 1.0)), "audit", ["close"])
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 50 and 0 < seen.get["null_close"] < 50


def test_profile(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 4)], "a double, b int")
    rows = {r.column_name: r for r in quality.dataset_profile(df, ["a", "b"]).collect()}
    assert (rows["a"].row_count, rows["a"].null_count, rows["a"].mean_value, rows["a"].max_value) == (2, 0, 2.0, 3.0)
    assert (rows["b"].null_count, rows["b"].min_value, rows["b"].std_value) == (1, 4.0, None)


def test_missing_days_equal_the_spine_without_the_data(spark, rows_of):
    days = spark.sql("select s as symbol, date_add(date'2024-01-28', d) as date from values ('A',0),('A',1),('A',5),('B',2),('C',0),('C',9) t(s,d)")
    spine = calendar.calendar_spine(days)
    expected = spine.join(days, ["symbol", "date"], "left_anti").select("date", "symbol")
    assert rows_of(calendar.missing_days(days)) == rows_of(expected)
    assert calendar.missing_days(days).count() == 3 + 8


def test_gaps_of_a_null_series_are_kept(spark):
    rows = [(None, 0, 1.0), (None, 500, 2.0), ("A", 0, 1.0), ("A", 100, 2.0)]
    top = quality.large_gaps(spark.createDataFrame(rows, BARS), threshold=60, top=1).collect()
    assert [(r.symbol, r.timestamp, r.gap, r.close) for r in top] == [(None, 500, 500, 2.0)]


def test_gaps_scan_their_input_once(spark, tmp_path):
    random_bars(spark).write.parquet(str(tmp_path / "bars"))
    gaps = quality.time_gaps(spark.read.parquet(str(tmp_path / "bars")), unique=True)
    gaps.collect()
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1


def test_profile_of_dates_and_text(spark):
    df = spark.sql("select date'2024-02-01' as d, 'b' as s, 1.5D as x, true as f union all select null, 'a', null, false")
    rows = {r.column_name: r for r in quality.dataset_profile(df, ["d", "s", "x", "f"]).collect()}
    assert (rows["d"].first_value, rows["d"].null_count, rows["d"].mean_value) == ("2024-02-01", 1, None)
    assert (rows["s"].first_value, rows["s"].last_value) == ("a", "b")
    assert (rows["x"].min_value, rows["x"].first_value, rows["x"].null_count) == (1.5, None, 1)
    assert rows["f"].last_value == "true"
