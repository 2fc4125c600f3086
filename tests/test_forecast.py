import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.forecast import (
    DEFAULT_GRID,
    Event,
    best_config,
    cv_scores,
    event_features,
    fold_sizes,
    forecast,
    forecast_errors,
    forecast_metrics,
    future_frame,
    shift_regressors,
    split_by_time,
    with_configs,
    with_errors,
    with_folds,
)
from tidemark.forecast import fit
from tidemark.forecast.fit import COMPONENTS, fit_series

START = dt.date(2020, 1, 1)
FRAME = "symbol string, ds date, y double, ma7 double, ma30 double"


def series(n, value, symbol="A"):
    return [(symbol, START + dt.timedelta(days=i), float(value(i)), 0.0, 0.0) for i in range(n)]


def weekly_wave(i):
    return 100 + 0.5 * i + 10 * math.sin(2 * math.pi * i / 7) + (40 if i == 50 else 0)


def as_pandas(rows, train, mode="additive", prior=0.05, event_day=None):
    pdf = pd.DataFrame(rows, columns=["symbol", "ds", "y", "ma7", "ma30"])
    pdf["is_train"] = [i < train for i in range(len(pdf))]
    pdf["event_keys"] = [["jump_0"] if i == event_day else [] for i in range(len(pdf))]
    return pdf.assign(mode=mode, prior=prior)


def test_the_fit_recovers_trend_week_and_event():
    out = fit_series(as_pandas(series(400, weekly_wave), 320, event_day=50))
    assert (out["status"] == "ok").all()
    test = out[320:]
    assert np.abs(test["y"] - test["yhat"]).max() < 3.0
    assert np.allclose(out["trend"].diff().iloc[5:300].mean(), 0.5, atol=0.05)
    assert np.abs(out["weekly"]).max() == pytest.approx(10, abs=1.0)
    assert out["events"].iloc[50] == pytest.approx(40, abs=4) and out["events"].drop(50).abs().max() == 0
    assert np.allclose(out[list(COMPONENTS)].sum(axis=1), out["yhat"])
    assert ((out["yhat_lower"] <= out["yhat_upper"])).all()


def test_multiplicative_season_grows_with_the_trend():
    def wave(i):
        return (100 + i) * (1 + 0.2 * math.sin(2 * math.pi * i / 7))

    rows = series(400, wave)
    error = {
        mode: np.abs(out["y"] - out["yhat"])[320:].mean()
        for mode in ("additive", "multiplicative")
        for out in [fit_series(as_pandas(rows, 320, mode))]
    }
    assert error["multiplicative"] < 2.0 < error["additive"]


def test_yearly_terms_need_two_years():
    short = fit_series(as_pandas(series(400, weekly_wave), 320))
    long = fit_series(as_pandas(series(1200, lambda i: 100 + 20 * math.sin(2 * math.pi * i / 365.25)), 1000))
    assert short["yearly"].abs().max() == 0 and long["yearly"].abs().max() > 10
    assert np.abs(long["y"] - long["yhat"])[1000:].max() < 5


def test_hopeless_series_get_a_status_and_the_job_survives(spark):
    rows = series(1, lambda i: 5, "one") + series(60, lambda i: 7, "flat") + series(60, weekly_wave, "good") + series(60, lambda i: 0, "zero")
    frame = split_by_time(spark.createDataFrame(rows, FRAME)).withColumn("event_keys", F.array().cast("array<string>"))
    out = forecast(with_configs(frame), tasks=4).cache()
    status = {r.symbol: r.s for r in out.groupBy("symbol").agg(F.max("status").alias("s")).collect()}
    assert status == {"one": "too_short", "flat": "ok", "good": "ok", "zero": "ok"}
    assert out.count() == len(rows) * len(DEFAULT_GRID)
    assert out.filter("symbol = 'flat' and abs(yhat - 7) > 0.01").count() == 0
    metrics = forecast_metrics(out.withColumn("error", F.col("y") - F.col("yhat")).withColumn("abs_error", F.abs("error")).withColumn("pct_error", F.abs("error")), ("symbol", "config_id"))
    assert {r.symbol for r in best_config(metrics).collect()} == {"flat", "good", "zero"}


def test_groups_are_spread_over_tasks(spark):
    frame = spark.createDataFrame(series(30, weekly_wave), FRAME).withColumn("is_train", F.lit(True))
    frame = frame.withColumn("event_keys", F.array().cast("array<string>"))
    plan = forecast(with_configs(frame), tasks=6)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1


def test_split_is_by_time(spark, rows_of):
    split = split_by_time(spark.createDataFrame(series(10, float) + series(1, float, "B"), FRAME))
    assert split.filter("is_train").count() == 8
    assert split.filter("is_train").agg(F.max("ds")).first()[0] < split.filter("not is_train and symbol = 'A'").agg(F.min("ds")).first()[0]


def test_future_rows_and_regressor_timing(spark):
    rows = [("A", START + dt.timedelta(days=i), float(i), 10.0 + i, None) for i in range(3)]
    grown = future_frame(spark.createDataFrame(rows, FRAME), horizon=2)
    assert [r.ma7 for r in grown.orderBy("ds").collect()] == [10, 11, 12, 12, 12]
    lagged = shift_regressors(grown, "lagged").orderBy("ds").collect()
    assert [r.ma7 for r in lagged] == [0, 10, 11, 12, 12] and {r.ma30 for r in lagged} == {0.0}
    assert [r.y for r in lagged] == [0, 1, 2, None, None] and [r.is_future for r in lagged][-2:] == [True, True]
    with pytest.raises(ValueError):
        shift_regressors(grown, "tomorrow")


def test_event_windows(spark, rows_of):
    frame = spark.createDataFrame(series(40, float) + series(40, float, "B"), FRAME)
    events = [Event("A", "sale", START + dt.timedelta(days=10)), Event("A", "fair", START + dt.timedelta(days=12), 0, 1)]
    marked = event_features(frame, events)
    assert marked.count() == 80 and marked.filter("symbol = 'B' and size(event_keys) > 0").count() == 0
    days = {(r.ds - START).days: r.event_keys for r in marked.filter("size(event_keys) > 0").collect()}
    assert sorted(days) == list(range(3, 18))
    assert days[3] == ["sale_-7"] and days[12] == ["fair_0", "sale_2"] and days[17] == ["sale_7"]
    assert event_features(frame, []).filter("size(event_keys) > 0").count() == 0


def test_fold_cutoffs(spark):
    # 818 training days; the cutoffs are the days 758, 773 and 788 counted from 1.
    frame = spark.createDataFrame(series(1022, float), FRAME).withColumn("is_train", F.col("ds") < F.lit(START + dt.timedelta(days=818)))
    sizes = fold_sizes(with_folds(frame)).orderBy("fold").collect()
    assert [(r.cutoff - START).days + 1 for r in sizes] == [758, 773, 788]
    assert [(r.train_rows, r.test_rows) for r in sizes] == [(758, 30), (773, 30), (788, 30)]


def test_errors_metrics_and_choice(spark):
    actual = spark.createDataFrame([("A", START, 10.0), ("A", START + dt.timedelta(days=1), 0.0)], "symbol string, ds date, y double")
    predicted = actual.withColumn("yhat", F.lit(8.0)).withColumn("config_id", F.lit(2)).drop("y")
    predicted = predicted.unionByName(predicted.withColumn("config_id", F.lit(1)))
    predicted = predicted.unionByName(predicted.withColumn("config_id", F.lit(0)).withColumn("yhat", F.lit(float("nan"))))
    errors = forecast_errors(predicted, actual)
    first = errors.filter(f"ds = '{START}' and config_id = 1").first()
    assert (first.error, first.abs_error, first.pct_error) == (2.0, 2.0, 20.0)
    zero = errors.filter("y = 0 and config_id = 1").first()
    assert zero.pct_error == pytest.approx(8.0 / 1e-8 * 100)
    metrics = forecast_metrics(errors, ("symbol", "config_id"))
    row = metrics.filter("config_id = 1").first()
    assert (row.mse, row.mae, row.n) == (34.0, 5.0, 2) and row.rmse == pytest.approx(math.sqrt(34))
    assert best_config(metrics).first().config_id == 1


def test_spark_fits_and_folds_equal_a_plain_loop(spark):
    rows = series(260, weekly_wave) + series(260, lambda i: 50 + i % 7, "B")
    frame = split_by_time(spark.createDataFrame(rows, FRAME)).withColumn("event_keys", F.array().cast("array<string>"))
    frame = frame.withColumns({"mode": F.lit("additive"), "prior": F.lit(0.05)})
    fitted = {(r.symbol, r.ds): r.yhat for r in forecast(frame, by=("symbol",), tasks=3).collect()}
    folds = forecast(with_folds(frame), by=("symbol", "fold"), tasks=3)
    scores = {r.symbol: r.cv_mape for r in cv_scores(folds).collect()}

    for symbol in "AB":
        mine = [r for r in rows if r[0] == symbol]
        plain = fit_series(as_pandas(mine, 208))
        assert np.allclose([fitted[symbol, d] for d in plain["ds"]], plain["yhat"], rtol=1e-9)
        errors = []
        for cutoff in (208 - 60, 208 - 45, 208 - 30):
            part = fit_series(as_pandas(mine[: cutoff + 30], cutoff))[cutoff:]
            errors.extend(np.abs(part["y"] - part["yhat"]) / part["y"] * 100)
        assert len(errors) == 90 and scores[symbol] == pytest.approx(np.mean(errors), rel=1e-9)


def test_the_fit_travels_to_workers_without_the_package():
    assert "tidemark.forecast.fit" in cloudpickle.list_registry_pickle_by_value()


def test_candidates_in_one_group_equal_one_copy_each(spark, rows_of):
    frame = spark.createDataFrame(
        [("A", START + dt.timedelta(days=i), 100.0 + i + 3 * math.sin(i), i < 70, ["e_0"] if i % 30 == 3 else [], 1.0 + i, 2.0) for i in range(90)],
        "symbol string, ds date, y double, is_train boolean, event_keys array<string>, ma7 double, ma30 double",
    )
    columns = ("config_id", "mode", "prior", "ds", "yhat", "yhat_lower", "status", "seasons")
    once, copied = forecast(frame, by=("symbol",), grid=DEFAULT_GRID), forecast(with_configs(frame))
    for a, b in zip(rows_of(once, *columns), rows_of(copied, *columns), strict=True):
        assert a[:4] == b[:4] and a[4:6] == pytest.approx(b[4:6], abs=1e-9) and a[6:] == b[6:]
    assert once.select("seasons").distinct().collect()[0][0] == "weekly"


def test_a_hole_inside_the_history_is_not_the_future(spark):
    frame = spark.createDataFrame([(dt.date(2024, 1, d), float(d), "A", 1.0, 1.0) for d in (1, 4)], "ds date, y double, symbol string, ma7 double, ma30 double")
    rows = future_frame(frame, horizon=2).orderBy("ds").collect()
    assert [r.is_future for r in rows] == [False] * 4 + [True] * 2


def test_exact_metrics_hold_large_errors(spark):
    errors = with_errors(spark.createDataFrame([("A", 1e13, 0.0), ("A", 0.0, 5.0)], "symbol string, y double, yhat double"))
    row = forecast_metrics(errors, scale=6).first()
    assert row.mae == pytest.approx(5e12, rel=1e-6) and row.mape == pytest.approx((100 + 5e10) / 2, rel=1e-6)
    from tidemark.functions.numeric import out_of_range

    assert errors.agg(out_of_range("error", 6).alias("n")).first().n == 1


def test_bounds_widen_with_the_horizon_as_drawn_trend_changes_do():
    """The closed form against seeded draws: Poisson many changes at uniform times, Laplace-distributed sizes."""
    days, train = np.arange(400.0), np.arange(400) < 300
    rate, size, noise = 25.0, 0.04, 0.03
    wider = fit._widening(days, train, (rate, size), noise)
    assert (wider[train] == 0).all() and (np.diff(wider[300:]) > 0).all()
    rng = np.random.default_rng(5)
    for at in (330, 399):
        h = (at - 299) / 299
        n = rng.poisson(rate * h, 200_000)
        owner = np.repeat(np.arange(len(n)), n)
        off = np.bincount(owner, rng.laplace(0, size, n.sum()) * (h - rng.uniform(0, h, n.sum())), minlength=len(n))
        drawn = np.sqrt(noise**2 + off.var()) - noise
        assert abs(wider[at] / (1.2815515655 * drawn) - 1) < 0.02


def test_wider_trend_changes_give_wider_bounds():
    rng = np.random.default_rng(2)

    def width(step):
        slope = np.repeat(np.cumsum(rng.normal(0, step, 8)), 50)
        frame = pd.DataFrame(
            {
                "ds": pd.date_range("2020-01-01", periods=430).date,
                "y": [*(100 + np.cumsum(slope) + rng.normal(0, 0.1, 400)), *[np.nan] * 30],
                "is_train": [True] * 400 + [False] * 30,
                "event_keys": [[]] * 430,
                "mode": "additive",
                "prior": 0.5,
            }
        )
        out = fit.fit_series(frame, (), fit.Terms(seasons=(), regressors=False))
        return (out["yhat_upper"] - out["yhat_lower"]).to_numpy()

    calm, wild = width(0.001), width(0.2)
    for w in (calm, wild):
        assert np.allclose(w[:400], w[0]) and (np.diff(w[400:]) > 0).all()
    assert wild[-1] - wild[0] > 5 * (calm[-1] - calm[0])
