"""Sketches, footers, global positions and event tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.forecast import Event, event_features, event_table_features, events_table
from tidemark.operators.normalize import with_derived
from tidemark.operators.positions import rows_between, with_positions
from tidemark.operators.quality import footer_marks, series_marks
from tidemark.operators.sketches import DISTINCT_ERROR, QUANTILES, RANK_ERROR, read_sketches, sketch_profile, store_sketches
from tidemark.sinks import write_partitioned


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_equal_row_numbers(spark, parts):
    rng = random.Random(1)
    rows = [(rng.randrange(20), i, f"t{i}") for i in range(500)] + [(None, 1000, None)]
    df = spark.createDataFrame(rows, "v int, id int, position_text string").repartition(5)
    got = with_positions(df, [F.desc("v"), "id"], parts=parts)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [r["id"] for r in got.orderBy("position").collect()] == [r[1] for r in want]
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 502))
    assert [r["id"] for r in rows_between(got, 100, 104).orderBy("position").collect()] == [r[1] for r in want[99:104]]


def test_positions_have_no_window_over_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = with_positions(df, ["v", "id"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    # The one window is over the ranges' sizes, below it an aggregate.
    assert len(windows) == 1 and "sum(_size" in windows[0]
    assert with_positions(df.limit(0), ["v"]).count() == 0


def test_marks_come_from_footers(spark, tmp_path, rows_of):
    rows = [("007", 60 * i, float(i)) for i in range(100_000)] + [("B", 5, 1.0), ("B", 86_400 * 400, 2.0)]
    bars = with_derived(spark.createDataFrame(rows, "symbol string, timestamp bigint, close double"))
    path = str(tmp_path / "bars")
    write_partitioned(bars, path)
    found = footer_marks(spark, path, "timestamp", ("symbol", "year", "month"))
    plan = plan_of(found)
    assert "PushedAggregation: [MIN(timestamp), MAX(timestamp), COUNT(*)]" in plan
    assert "PushedGroupBy: [symbol, year, month]" in plan
    assert rows_of(series_marks(spark, path)) == [("007", 0, 60 * 99_999, 100_000), ("B", 5, 86_400 * 400, 2)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_merge_within_their_bounds(spark, tmp_path):
    rng = random.Random(3)
    values = [(i % 9, rng.gauss(0, 1) if i % 10 else None, f"k{i % 2500}") for i in range(40_000)]
    # One part with a third of the rows, all of one value.
    values += [(99, 7.0, "same")] * 20_000
    df = spark.createDataFrame(values, "p int, x double, k string").repartition(8)
    path = str(tmp_path / "s")
    store_sketches(df, path, ["x", "k", "p"], "p")
    for r in sketch_profile(read_sketches(spark, path)).collect():
        column = r["column"]
        held = sorted(v for v in (row[["p", "x", "k"].index(column)] for row in values) if v is not None)
        assert (r["rows"], r["nulls"]) == (60_000, 60_000 - len(held))
        exact = len(set(held))
        assert abs(r["distinct"] - exact) <= DISTINCT_ERROR * exact
        for i, p in enumerate(QUANTILES, start=1):
            at = r[f"q{i}"]
            assert (at is None) == (column == "k")
            if at is not None:
                low, high = (sum(v < at for v in held) / len(held), sum(v <= at for v in held) / len(held))
                assert low - RANK_ERROR <= p <= high + RANK_ERROR


def test_only_changed_parts_are_sketched_again(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), F.col("id").cast("double").alias("x"))
    store_sketches(df, path, ["x"], "p")

    def files():
        return {(d, n, os.stat(os.path.join(d, n)).st_mtime_ns) for d, _, names in os.walk(path) for n in names if n.startswith("part-")}

    before = files()
    store_sketches(df.filter("p = 1").unionByName(df.filter("p = 1")), path, ["x"], "p")
    assert {f for f in before if "part=1" not in f[0]} <= files()
    assert sketch_profile(read_sketches(spark, path)).first()["rows"] == 1000 + 333


def test_empty_columns_have_no_quantiles(spark, tmp_path):
    path = str(tmp_path / "s")
    store_sketches(spark.createDataFrame([(1, None, None), (2, None, None)], "p int, x double, t string"), path, ["x", "t"], "p")
    for r in sketch_profile(read_sketches(spark, path)).collect():
        assert (r["rows"], r["nulls"], r["distinct"], r["q3"]) == (2, 2, 0, None)


EVENTS = (
    Event("A", "cut", dt.date(2020, 2, 10)),
    Event("A", "cut", dt.date(2020, 2, 12), -3, 2),
    Event("A", "split", dt.date(2020, 1, 1), -40, 90),
    Event("B", "cut", dt.date(2019, 12, 31), 0, 0),
    Event("B", "none", dt.date(2020, 1, 5), 3, -3),
)


@pytest.mark.parametrize("bin_days", [1, 7, 32, 1000])
def test_events_of_a_table_equal_those_of_a_list(spark, bin_days):
    days = [(s, dt.date(2019, 11, 1) + dt.timedelta(days=i)) for s in "ABC" for i in range(200)]
    frame = spark.createDataFrame([*days, ("A", None), (None, dt.date(2020, 1, 1))], "symbol string, ds date")
    table = events_table(spark, [*EVENTS, EVENTS[0]])
    got = event_table_features(frame, table, bin_days=bin_days)
    want = event_features(frame, EVENTS)
    key = lambda r: (str(r["symbol"]), str(r["ds"]))
    assert [(*key(r), r["event_keys"]) for r in sorted(got.collect(), key=key)] == [(*key(r), sorted(r["event_keys"])) for r in sorted(want.collect(), key=key)]
    assert event_table_features(frame, table.limit(0)).filter("size(event_keys) > 0").count() == 0
