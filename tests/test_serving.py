"""Incremental publication against the full recomputation."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.operators.calendar import fill_calendar, moving_averages
from tidemark.operators.layers import fill_forward, merge_layers
from tidemark.sinks import PublishConflict, publish, read_manifest, read_published
from tidemark.sources.storage import exists

FIRST = dt.date(2019, 11, 1)
SCHEMA = "symbol string, date date, daily_open double, daily_high double, daily_low double, daily_close double, daily_volume double"
COLUMNS = ("symbol", "date", "daily_open", "daily_close", "daily_volume", "ma7", "ma30")


def days(rng, symbol, offsets, shift=0.0):
    out = []
    for k in offsets:
        p = round(rng.uniform(10, 20), 2) + shift
        out.append((symbol, FIRST + dt.timedelta(days=k), p, p + 1, p - 1, p + 0.5, float(k + 1)))
    return out


def recomputed(stored, fresh, until=None, policy="zero"):
    end = None if until is None else F.lit(until).cast("date")
    return fill_forward(merge_layers([stored, fresh]), until=end, volume_policy=policy)


def files(layout, table="daily_filled"):
    return {
        os.path.join(d, n)
        for d, _, names in os.walk(os.path.join(layout.serving, table))
        for n in names
        if n.startswith("part-")
    }


@pytest.fixture
def layout(spark, tmp_path):
    """Three series of 420 days, over four years."""
    rng = random.Random(1)
    rows = [r for s in "ABC" for r in days(rng, s, [k for k in range(420) if k in (0, 419) or rng.random() > 0.1])]
    layout = plans.Layout(str(tmp_path / "t"))
    plans.publish_daily(spark, layout, moving_averages(fill_calendar(spark.createDataFrame(rows, SCHEMA))))
    return layout


CASES = {
    "days behind the end": {"A": range(420, 425)},
    "a hole behind the end": {"A": [430, 431, 440], "B": [425]},
    "days that are stored": {"A": range(400, 420)},
    "stored and new days": {"A": range(410, 423), "B": [3, 418, 421]},
    "a new series": {"A": [420], "D": [100, 105, 430]},
    "a series that begins earlier": {"B": [-20, -3], "C": [421]},
    "nothing": {},
}


@pytest.mark.parametrize(
    ("case", "until", "policy"),
    [(case, None, "zero") for case in CASES if case != "nothing"]
    + [("stored and new days", "2021-01-31", "carry"), ("a series that begins earlier", "2021-01-31", "zero"), ("nothing", "2021-01-31", "zero")],
)
def test_a_merge_equals_the_full_recomputation(spark, layout, rows_of, case, until, policy):
    rng = random.Random(case)
    if policy == "carry":
        plans.publish_daily(spark, layout, plans.read_daily(spark, layout).drop("year", "month"), policy)
    fresh = spark.createDataFrame([r for s, offsets in CASES[case].items() for r in days(rng, s, offsets, 5.0)], SCHEMA)
    want = rows_of(recomputed(plans.read_daily(spark, layout), fresh, until, policy), *COLUMNS)
    plans.merge_daily(spark, layout, fresh, until=until)
    got = plans.read_daily(spark, layout)
    assert rows_of(got, *COLUMNS) == want
    assert got.filter("year <> year(date) or month <> month(date)").count() == 0
    assert rows_of(plans.read_model_input(spark, layout)) == rows_of(got.select("date", "daily_close", "symbol"))
    marks = got.groupBy("symbol").agg(F.min("date"), F.max("date"))
    assert rows_of(plans.read_marks(spark, layout)) == rows_of(marks)


def test_years_without_a_change_keep_their_files(spark, layout):
    before = {t: files(layout, t) for t in ("daily_filled", "model_input")}
    plans.merge_daily(spark, layout, spark.createDataFrame(days(random.Random(2), "A", [420, 421]), SCHEMA))
    for table, old in before.items():
        now = files(layout, table)
        assert all("year=2020" in p or "year=2021" in p for p in now - old)
        assert {p for p in old if "year=2019" in p} <= now
    held = read_manifest(spark, layout.serving)["tables"]["daily_filled"]["years"]
    assert held == {"2019": 1, "2020": 2}


def test_a_merge_reads_only_the_years_from_its_change_on(spark, layout, monkeypatch):
    asked = []
    real = plans.serving.read_published
    monkeypatch.setattr(plans.serving, "read_published", lambda s, r, t, years=None, **k: asked.append((t, years)) or real(s, r, t, years, **k))
    plans.merge_daily(spark, layout, spark.createDataFrame(days(random.Random(2), "A", [470]), SCHEMA))
    daily = [years for table, years in asked if table == "daily_filled"]
    assert daily and all(2019 not in (years or [2019]) for years in daily[2:])


def test_nothing_fresh_publishes_nothing(spark, layout):
    fresh = spark.createDataFrame(days(random.Random(2), "A", range(300, 310)), SCHEMA)
    assert plans.merge_daily(spark, layout, fresh) is None
    assert read_manifest(spark, layout.serving)["number"] == 1


def test_readers_of_the_state_before_keep_it(spark, layout):
    old = plans.read_daily(spark, layout)
    n = old.count()
    plans.merge_daily(spark, layout, spark.createDataFrame(days(random.Random(2), "A", [420]), SCHEMA))
    assert old.count() == n and plans.read_daily(spark, layout, back=1).count() == n
    assert plans.read_daily(spark, layout).count() == n + 1


def test_old_folders_go_with_their_manifests(spark, layout):
    for k in range(420, 424):
        plans.merge_daily(spark, layout, spark.createDataFrame(days(random.Random(2), "A", [k]), SCHEMA))
    held = sorted(os.listdir(os.path.join(layout.serving, "daily_filled")))
    assert held == ["gen=000001", "gen=000004", "gen=000005"]  # 2019 is still in the first
    assert os.listdir(os.path.join(layout.serving, "daily_filled", "gen=000001")).count("year=2020") == 0
    assert plans.read_daily(spark, layout).filter("symbol = 'A'").count() == 424


def test_publishing_from_an_old_state_is_refused(spark, layout):
    table = plans.read_daily(spark, layout)
    publish(spark, layout.serving, {"daily_filled": table}, after=1)
    with pytest.raises(PublishConflict):
        publish(spark, layout.serving, {"daily_filled": table}, after=1)


def test_an_attempt_that_died_is_not_seen_and_is_replaced(spark, layout, tmp_path):
    root = layout.serving
    n = read_published(spark, root, "daily_filled").count()
    dead = f"{root}/daily_filled/gen=000002/year=2020"
    os.makedirs(dead)
    open(f"{dead}/part-00000.parquet", "w").write("half written")
    assert read_published(spark, root, "daily_filled").count() == n
    plans.merge_daily(spark, layout, spark.createDataFrame(days(random.Random(2), "A", [420]), SCHEMA))
    assert read_published(spark, root, "daily_filled").count() == n + 1


def test_a_set_that_was_never_published(spark, tmp_path):
    layout = plans.Layout(str(tmp_path / "none"))
    assert plans.read_daily(spark, layout) is None and plans.read_marks(spark, layout) is None
    assert not exists(spark, layout.serving)
    with pytest.raises(FileNotFoundError):
        plans.merge_daily(spark, layout, spark.createDataFrame([], SCHEMA))
