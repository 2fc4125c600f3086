"""Folds from prefix sums of moments against folds fitted from rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.forecast import DEFAULT_GRID, best_config, cross_validate, cv_scores, cv_summary, forecast, forecast_metrics, with_errors, with_folds
from tidemark.forecast.fit import LINEAR, Terms
from tidemark.forecast.validate import Moments, additive_folds, row_folds, validate_series

START = np.datetime64("2019-03-01")


def history(seed, n, holes=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 500 + 0.4 * t + 30 * np.sin(t / 58) + 9 * np.sin(2 * np.pi * t / 7) + np.cumsum(rng.normal(0, 3, n))
    if holes:
        y[rng.choice(n - 70, holes, replace=False)] = np.nan
    keys = [["cut_0"] if k in (40, n - 45) else ["cut_0", "z_1"] if k == n - 20 else [] for k in t]
    flat = pd.Series(y).interpolate(limit_direction="both")
    return pd.DataFrame({"ds": START + t, "y": y, "ma7": flat.rolling(7, min_periods=1).mean().shift(1, fill_value=0.0), "ma30": 3.0, "event_keys": keys})


CASES = [(1, 200, 0), (2, 800, 0), (3, 800, 40), (4, 90, 0), (5, 61, 0)]


@pytest.mark.parametrize(("seed", "n", "holes"), CASES)
@pytest.mark.parametrize("terms", [Terms(), LINEAR, Terms(changepoints=3, events=False), Terms(seasons=(("weekly", 7.0, 3, 14),), regressors=False)])
def test_folds_from_moments_equal_folds_from_rows(seed, n, holes, terms):
    rows = history(seed, n, holes)
    last = rows["ds"].max().to_numpy().astype("datetime64[D]") if hasattr(rows["ds"].max(), "to_numpy") else np.datetime64(rows["ds"].max(), "D")
    cutoffs = [last - np.timedelta64(d, "D") for d in (60, 45, 30)]
    cutoffs = [c for c in cutoffs if (rows["ds"].to_numpy("datetime64[D]") <= c).sum() >= 2]
    got = additive_folds(rows, cutoffs, 30, 0.05, ("ma7", "ma30"), terms)
    want = row_folds(rows, cutoffs, 30, "additive", 0.05, ("ma7", "ma30"), terms)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g["ds"].tolist() == w["ds"].tolist()
        assert np.allclose(g["yhat"], w["yhat"], rtol=1e-7, atol=0)


def test_moments_of_parts_add_up():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 4)), rng.normal(size=50)
    whole, parts = Moments.of(x, y), Moments.of(x[:17], y[:17]) + Moments.of(x[17:], y[17:])
    assert whole.n == parts.n and np.allclose(whole.gram, parts.gram) and np.allclose(whole.moment, parts.moment)
    basis = rng.normal(size=(4, 3))
    direct = Moments.of(x @ basis, y / 7.0)
    assert np.allclose(whole.under(basis, 7.0).gram, direct.gram) and np.isclose(whole.under(basis, 7.0).square, direct.square)


def test_a_series_without_enough_rows_has_no_choice():
    rows = history(1, 5).assign(is_train=[True] * 4 + [False])
    grid = [(c.config_id, c.mode, c.prior) for c in DEFAULT_GRID]
    made = validate_series(rows, grid, ("ma7", "ma30"), Terms())
    assert made.loc[made["fold"] > 0, "yhat"].isna().all() and (made["fold"] == 0).any()
    none = validate_series(rows.assign(y=np.nan), grid, ("ma7", "ma30"), Terms())
    assert len(none) == 0 and list(none.columns)[:2] == ["config_id", "mode"]


def test_one_pass_equals_choice_and_folds_by_refits(spark):
    frames = []
    for seed, symbol in ((1, "A"), (2, "B"), (3, "C")):
        rows = history(seed, 260).assign(symbol=symbol)
        rows["is_train"] = np.arange(260) < 208
        frames.append(rows)
    frames.append(history(4, 3).assign(symbol="short", is_train=[True, True, False]))
    pdf = pd.concat(frames, ignore_index=True)
    rows = [(r.symbol, r.ds.date(), float(r.y), float(r.ma7), float(r.ma30), list(r.event_keys), bool(r.is_train)) for r in pdf.itertuples()]
    frame = spark.createDataFrame(rows, "symbol string, ds date, y double, ma7 double, ma30 double, event_keys array<string>, is_train boolean")
    got = {r["symbol"]: r for r in cv_summary(cross_validate(frame, DEFAULT_GRID)).collect()}
    tested = forecast(frame, by=("symbol",), grid=DEFAULT_GRID).filter(~F.col("is_train") & F.col("y").isNotNull())
    best = best_config(forecast_metrics(with_errors(tested), by=("symbol", "config_id", "mode", "prior")))
    folds = forecast(with_folds(frame).join(best.select("symbol", "config_id", "mode", "prior"), "symbol"), by=("symbol", "fold"))
    want = {r["symbol"]: r for r in best.join(cv_scores(folds), "symbol", "left").collect()}
    assert set(got) == set(want) >= {"A", "B", "C"}
    for symbol, w in want.items():
        g = got[symbol]
        assert (g["config_id"], g["n"]) == (w["config_id"], w["n"])
        for c in ("mse", "mape", "mae", "rmse"):
            assert g[c] == pytest.approx(w[c], rel=1e-9)
        if symbol != "short":
            assert g["folds"] == w["folds"] == 3 and g["cv_mape"] == pytest.approx(w["cv_mape"], rel=1e-9)


def test_folds_carry_their_cutoffs(spark):
    rows = history(2, 260)
    frame = spark.createDataFrame(
        [("A", r.ds.date(), float(r.y), 1.0, 1.0, [], i < 208) for i, r in enumerate(rows.itertuples())],
        "symbol string, ds date, y double, ma7 double, ma30 double, event_keys array<string>, is_train boolean",
    )
    made = cross_validate(frame, DEFAULT_GRID[:1])
    last = dt.date(2019, 3, 1) + dt.timedelta(days=207)
    got = {(r["fold"], r["cutoff"], r["n"]) for r in made.groupBy("fold", "cutoff").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, None, 52)} | {(k, last - dt.timedelta(days=d), 30) for k, d in ((1, 60), (2, 45), (3, 30))}
