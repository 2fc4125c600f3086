import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layers

DAILY = "symbol string, date date, daily_open double, daily_high double, daily_low double, daily_close double, daily_volume double"


def table(spark, days, value, symbol="A"):
    rows = [(symbol, dt.date(2024, 1, d), *([float(value + d)] * 5)) for d in days]
    return spark.createDataFrame(rows, DAILY)


@pytest.mark.parametrize("partitions", [1, 2, 200])
def test_the_batch_row_wins_under_any_partitioning(spark, rows_of, partitions):
    batch = table(spark, range(1, 11), 0).repartition(partitions)
    speed = table(spark, range(8, 15), 100).repartition(partitions)
    merged = layers.merge_layers([batch, speed])
    assert rows_of(merged, "date", "daily_close") == [
        (dt.date(2024, 1, d), float(d if d <= 10 else d + 100)) for d in range(1, 15)
    ]
    assert rows_of(layers.layer_overlap(batch, speed), "date") == [(dt.date(2024, 1, d),) for d in (8, 9, 10)]
    assert layers.layer_only(speed, batch).count() == 4


def test_merging_a_layer_with_itself_changes_nothing(spark, rows_of):
    one = table(spark, range(1, 20), 0)
    assert rows_of(layers.merge_layers([one, one])) == rows_of(layers.merge_layers([one]))


def test_timestamp_dates_missing_columns_and_stale_averages(spark):
    batch = table(spark, [1], 0).withColumn("ma7", F.lit(999.0))
    speed = table(spark, [2], 0).withColumn("date", F.col("date").cast("timestamp")).drop("daily_volume")
    merged = layers.merge_layers([batch, speed])
    assert merged.schema["date"].dataType.simpleString() == "date"
    last = merged.orderBy(F.desc("date")).first()
    assert last.daily_volume is None and last.ma7 == 1.5


def test_incremental_slice_per_series(spark, rows_of):
    loaded = table(spark, [1, 2, 3], 0).unionByName(table(spark, [1], 0, "B"))
    fresh = table(spark, range(1, 8), 0).unionByName(table(spark, range(1, 4), 0, "B")).unionByName(table(spark, [2], 0, "C"))
    taken = layers.incremental_slice(fresh, loaded, F.lit(dt.date(2024, 1, 5)))
    assert rows_of(taken.select("symbol", F.dayofmonth("date"))) == [("A", 4), ("A", 5), ("B", 2), ("B", 3), ("C", 2)]
