"""The additive/multiplicative series model, fitted per group inside Spark tasks.

Trend, season and event terms follow the published decomposable model for business time
series (Taylor and Letham, 2018): piecewise-linear trend with changepoints over the first
80 % of the history, Fourier terms for year and week, event indicators and standardised
regressors. It is solved as penalised least squares, i.e. with Gaussian priors where the
paper puts a Laplace prior on the changepoints, so its numbers approximate that model.

One group is the daily series of one key under one candidate: its size is bounded by the
days in the covered span, not by the raw data.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.forecast.frame import REGRESSORS
from tidemark.forecast.grid import Config
from tidemark.schemas import require_columns

# The fit travels to the workers inside the task, so they need numpy and pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGEPOINT_RANGE = 0.8
SEASON_PRIOR = 10.0
INTERVAL = (0.1, 0.9)
COMPONENTS = ("trend", "yearly", "weekly", "events", "regressors")


@dataclass(frozen=True)
class Terms:
    """What the model is made of.

    ``seasons``: (component, period in days, Fourier order, least training span in days); a season
    is left out of a series with a shorter span, as the published model's automatic choice does,
    and the output names the seasons that were used. ``trend_prior=None`` fits offset and slope
    without a penalty. ``trend_changes`` is (changes per length of the history, mean size of one) for the
    future trend; ``None`` takes both from the fitted changepoints.
    """

    seasons: tuple[tuple[str, float, int, int], ...] = (("yearly", 365.25, 10, 730), ("weekly", 7.0, 3, 14))
    changepoints: int = 25
    trend_prior: float | None = 5.0
    events: bool = True
    regressors: bool = True
    trend_changes: tuple[float, float] | None = None


# Offset and slope alone: the ordinary least-squares line.
LINEAR = Terms(seasons=(), changepoints=0, trend_prior=None, events=False, regressors=False)


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2.0 * np.pi * np.outer(days / period, np.arange(1, order + 1))
    return np.hstack([np.sin(angles), np.cos(angles)])


def _ridge(design: np.ndarray, target: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    # The noise level that weighs the priors is unknown: solve, measure it, solve again.
    gram, moment, noise = design.T @ design, design.T @ target, 1e-2
    for _ in range(2):
        coef = np.linalg.lstsq(gram + np.diag(noise * penalty), moment, rcond=None)[0]
        noise = max(float(np.mean((target - design @ coef) ** 2)), 1e-10)
    return coef


def _blocks(
    pdf: pd.DataFrame, days: np.ndarray, train: np.ndarray, regressors: Sequence[str], terms: Terms
) -> dict[str, np.ndarray]:
    span = days[train].max() - days[train].min()
    blocks = dict.fromkeys(COMPONENTS[1:], np.zeros((len(days), 0)))
    for name, period, order, least in terms.seasons:
        if span >= least:
            blocks[name] = _fourier(days, period, order)
    keys = sorted({k for row in pdf["event_keys"] for k in row}) if terms.events else []
    hits = [[k in row for k in keys] for row in pdf["event_keys"]]
    blocks["events"] = np.array(hits, dtype=float).reshape(len(days), len(keys))
    if not terms.regressors:
        return blocks
    values = pdf[list(regressors)].to_numpy(float)
    spread = values[train].std(axis=0)
    blocks["regressors"] = (values - values[train].mean(axis=0)) / np.where(spread > 0, spread, 1.0)
    return blocks


def _trend_basis(days: np.ndarray, train: np.ndarray, changepoints: int) -> np.ndarray:
    # Changepoints lie evenly over the first part of the history, the published model's placing.
    first, last = days[train].min(), days[train].max()
    t = (days - first) / max(last - first, 1.0)
    history = np.sort(t[train])
    usable = max(int(len(history) * CHANGEPOINT_RANGE), 1)
    picks = np.linspace(0, usable - 1, min(changepoints, usable - 1) + 1).round().astype(int)[1:]
    return np.column_stack([np.ones_like(t), t, *[np.maximum(t - history[i], 0.0) for i in picks]])


def _widening(days: np.ndarray, train: np.ndarray, changes: tuple[float, float], noise: float) -> np.ndarray:
    """How much farther each bound lies on days behind the training range.

    Behind it the trend goes on changing: as often as in the history, by Laplace-distributed steps of the
    same mean size. After h (lengths of the history) the trend is off by the sum of the steps, each times
    the time since; for changes at rate r with mean size m that has the variance
    r * 2 m**2 * h**3 / 3. It adds to the variance of the residuals.
    """
    first, last = days[train].min(), days[train].max()
    h = np.maximum((days - last) / max(last - first, 1.0), 0.0)
    rate, size = changes
    z = NormalDist().inv_cdf(INTERVAL[1])
    return z * (np.sqrt(noise**2 + rate * 2.0 * size**2 * h**3 / 3.0) - noise)


def fit_series(pdf: pd.DataFrame, regressors: Sequence[str] = REGRESSORS, terms: Terms = Terms()) -> pd.DataFrame:
    """Fit on the training rows of one series and predict all of its rows."""
    pdf = pdf.sort_values("ds", ignore_index=True)
    y = pdf["y"].to_numpy(float)
    train = pdf["is_train"].fillna(False).to_numpy(bool) & np.isfinite(y)
    if train.sum() < 2:
        return pdf.assign(**dict.fromkeys(("yhat", "yhat_lower", "yhat_upper", *COMPONENTS), np.nan), seasons=None, status="too_short")
    days = pdf["ds"].to_numpy("datetime64[D]").astype(float)
    scale = np.abs(y[train]).max() or 1.0
    target = y[train] / scale
    trend_x, blocks = _trend_basis(days, train, terms.changepoints), _blocks(pdf, days, train, regressors, terms)
    effect_x = np.hstack(list(blocks.values()))
    n_trend, prior = trend_x.shape[1], float(pdf["prior"].iloc[0])
    free = 0.0 if terms.trend_prior is None else terms.trend_prior**-2
    trend_pen = np.r_[np.full(2, free), np.full(n_trend - 2, prior**-2)]
    effect_pen = np.full(effect_x.shape[1], SEASON_PRIOR**-2)

    if pdf["mode"].iloc[0] == "additive":
        coef = _ridge(np.hstack([trend_x, effect_x])[train], target, np.r_[trend_pen, effect_pen])
        trend_w, effect_w = coef[:n_trend], coef[n_trend:]
        base = np.ones(len(days))
    else:  # trend * (1 + effects): alternate between the two linear problems
        effect_w = np.zeros(effect_x.shape[1])
        for _ in range(5):
            lift = 1.0 + effect_x @ effect_w
            trend_w = _ridge((trend_x * lift[:, None])[train], target, trend_pen)
            base = trend_x @ trend_w
            effect_w = _ridge((effect_x * base[:, None])[train], target - base[train], effect_pen)
    parts, start = {"trend": trend_x @ trend_w * scale}, 0
    for name, block in blocks.items():
        stop = start + block.shape[1]
        parts[name] = block @ effect_w[start:stop] * base * scale
        start = stop
    yhat = sum(parts.values())
    residuals = y[train] - yhat[train]
    low, high = np.quantile(residuals, INTERVAL)
    steps = trend_w[2:]
    changes = terms.trend_changes or (len(steps), float(np.abs(steps).mean()) if len(steps) else 0.0)
    wider = _widening(days, train, changes, float(residuals.std()) / scale) * scale
    # Where effects multiply the trend, they multiply its error too.
    lifted = np.abs(1.0 + effect_x @ effect_w) if pdf["mode"].iloc[0] != "additive" else 1.0
    wider = wider * lifted
    used = ",".join(name for name, *_ in terms.seasons if blocks[name].shape[1])
    return pdf.assign(yhat=yhat, yhat_lower=yhat + low - wider, yhat_upper=yhat + high + wider, **parts, seasons=used, status="ok")


def _guarded(pdf: pd.DataFrame, regressors: Sequence[str], columns: Sequence[str], terms: Terms) -> pd.DataFrame:
    try:
        out = fit_series(pdf, regressors, terms)
    except (np.linalg.LinAlgError, ValueError, FloatingPointError) as failure:
        blank = dict.fromkeys(("yhat", "yhat_lower", "yhat_upper", *COMPONENTS), np.nan)
        out = pdf.assign(**blank, seasons=None, status=f"failed: {failure}")
    return out[list(columns)]


def forecast(
    frame: DataFrame,
    by: Sequence[str] = ("symbol", "config_id"),
    regressors: Sequence[str] = REGRESSORS,
    tasks: int | None = None,
    terms: Terms = Terms(),
    grid: Sequence[Config] = (),
) -> DataFrame:
    """Fit and predict every group of ``by``; a series that cannot be fitted gets a status row set.

    ``frame`` needs ds, y, is_train, event_keys, mode, prior and the regressors. With ``grid`` it has
    no mode and prior: a series is shuffled once and all candidates are fitted in its group, instead
    of one shuffled copy per candidate (:func:`with_configs`, for fewer series than cores). The explicit
    task count keeps adaptive coalescing from packing the (small but slow) groups together.

    The interval is the one of the training residuals, widened behind the training range by the
    variance of future trend changes.
    """
    if grid:
        frame = frame.withColumns({"config_id": F.lit(0), "mode": F.lit(""), "prior": F.lit(0.0)})
    carried = [*by, *[c for c in (*(("config_id",) if grid else ()), "ds", "y", "is_train", "cutoff", "mode", "prior") if c in frame.columns and c not in by]]
    needed = [*carried, "event_keys", *regressors]
    require_columns(frame, [*by, "ds", "y", "is_train", "event_keys", "mode", "prior", *regressors], "forecast")
    spark = frame.sparkSession
    added = ["yhat", "yhat_lower", "yhat_upper", *COMPONENTS]
    schema = T.StructType(
        [frame.schema[c] for c in carried]
        + [T.StructField(c, T.DoubleType()) for c in added]
        + [T.StructField("seasons", T.StringType()), T.StructField("status", T.StringType())]
    )
    columns, regressors = schema.fieldNames(), list(regressors)
    tasks = tasks or max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = frame.select(*needed).repartition(tasks, *by)
    candidates = tuple((c.config_id, c.mode, c.prior) for c in grid)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        if not candidates:
            return _guarded(pdf, regressors, columns, terms)
        fits = [_guarded(pdf.assign(config_id=i, mode=m, prior=p), regressors, columns, terms) for i, m, p in candidates]
        return pd.concat(fits, ignore_index=True)

    return spread.groupBy(*by).applyInPandas(fit, schema)
