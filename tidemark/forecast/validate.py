"""Choice and cross-validation of all candidates of a series in one pass.

A grouped task holds one series. It fits every candidate on the training range, takes the one with the
least error on the test range, and fits that one on every fold. Folds are prefixes of one
history, so an additive candidate isn't fitted from rows again: the history is cut at the cut-offs, each segment
has its moments (X'X, X'y, y'y, n) over one basis that holds the terms of all folds, and the prefix sums
of these moments are the folds' normal equations. A fold's own terms (its scaling of time, its
changepoints, its standardised regressors) are linear combinations of that basis. Multiplicative
candidates weigh rows by what they fit, so no fixed moments serve them; they are fitted from rows.

Scores are Spark aggregates of the predictions the tasks return.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.forecast.fit import CHANGEPOINT_RANGE, SEASON_PRIOR, Terms, _fourier, fit_series
from tidemark.forecast.frame import REGRESSORS
from tidemark.forecast.grid import DEFAULT_GRID, Config
from tidemark.forecast.score import best_config, forecast_metrics, with_errors
from tidemark.functions import pct_error
from tidemark.schemas import require_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Moments:
    """What least squares needs of some rows; those of two sets of rows add up."""

    n: int
    gram: np.ndarray
    moment: np.ndarray
    square: float

    @classmethod
    def of(cls, design: np.ndarray, target: np.ndarray) -> Moments:
        return cls(len(target), design.T @ design, design.T @ target, float(target @ target))

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.gram + other.gram, self.moment + other.moment, self.square + other.square)

    def under(self, basis: np.ndarray, scale: float) -> Moments:
        """The moments of the terms ``design @ basis`` and the target divided by ``scale``."""
        return Moments(self.n, basis.T @ self.gram @ basis, basis.T @ self.moment / scale, self.square / scale**2)

    def ridge(self, penalty: np.ndarray) -> np.ndarray:
        """Coefficients as the fit from rows finds them: the noise is measured once and weighs the priors."""
        noise = 1e-2
        for _ in range(2):
            coef = np.linalg.lstsq(self.gram + np.diag(noise * penalty), self.moment, rcond=None)[0]
            left = self.square - 2.0 * coef @ self.moment + coef @ self.gram @ coef
            noise = max(float(left) / self.n, 1e-10)
        return coef


def _picks(days: np.ndarray, terms: Terms) -> np.ndarray:
    """Days of the changepoints of a training range, placed as the fit places them."""
    history = np.sort(days)
    usable = max(int(len(history) * CHANGEPOINT_RANGE), 1)
    return history[np.linspace(0, usable - 1, min(terms.changepoints, usable - 1) + 1).round().astype(int)[1:]]


def additive_folds(
    pdf: pd.DataFrame, cutoffs: Sequence[np.datetime64], horizon: int, prior: float, regressors: Sequence[str], terms: Terms
) -> list[pd.DataFrame]:
    """Predictions for the ``horizon`` days behind each cut-off, fitted on the rows up to it, from prefix sums of moments."""
    dates = pdf["ds"].to_numpy("datetime64[D]")
    days, y = dates.astype(float), pdf["y"].to_numpy(float)
    known = np.isfinite(y)
    first = days[known].min()
    picks = [_picks(days[known & (dates <= c)], terms) for c in cutoffs]
    hinges = np.unique(np.concatenate(picks)) if terms.changepoints else np.zeros(0)
    seasons = [_fourier(days, period, order) for _, period, order, _ in terms.seasons]
    keys = sorted({k for row in pdf["event_keys"] for k in row}) if terms.events else []
    events = np.array([[k in row for k in keys] for row in pdf["event_keys"]], dtype=float).reshape(len(days), len(keys))
    values = pdf[list(regressors)].to_numpy(float) if terms.regressors else np.zeros((len(days), 0))
    values = values - values[known].mean(axis=0)
    trend = np.column_stack([np.ones_like(days), days - first, *[np.maximum(days - h, 0.0) for h in hinges]])
    design = np.hstack([trend, *seasons, events, values])
    edges = np.cumsum([0, trend.shape[1], *[s.shape[1] for s in seasons], events.shape[1], values.shape[1]])

    out, total, done = [], None, np.zeros(len(days), dtype=bool)
    for cutoff, own in sorted(zip(cutoffs, picks, strict=True), key=lambda x: x[0]):
        train = known & (dates <= cutoff)
        segment = train & ~done
        done |= segment
        part = Moments.of(design[segment], y[segment])
        total = part if total is None else total + part
        tested = (dates > cutoff) & (dates <= cutoff + np.timedelta64(horizon, "D"))
        if train.sum() < 2 or not tested.any():
            continue
        # The fold's terms as combinations of the basis.
        last, scale = days[train].max(), np.abs(y[train]).max() or 1.0
        span = max(last - first, 1.0)
        columns = [(0, 1.0), (1, 1.0 / span), *[(2 + int(np.searchsorted(hinges, h)), 1.0 / span) for h in own]]
        free = 0.0 if terms.trend_prior is None else terms.trend_prior**-2
        penalty = [free, free, *[prior**-2] * len(own)]
        for i, (_, _, _, least) in enumerate(terms.seasons):
            if last - first >= least:
                columns += [(c, 1.0) for c in range(edges[1 + i], edges[2 + i])]
        columns += [(c, 1.0) for c in range(edges[-3], edges[-2])]
        basis = np.zeros((design.shape[1], len(columns) + values.shape[1]))
        for j, (c, factor) in enumerate(columns):
            basis[c, j] = factor
        spread = values[train].std(axis=0)
        spread = np.where(spread > 0, spread, 1.0)
        for k in range(values.shape[1]):
            basis[edges[-2] + k, len(columns) + k] = 1.0 / spread[k]
            basis[0, len(columns) + k] = -values[train][:, k].mean() / spread[k]
        penalty = np.array(penalty + [SEASON_PRIOR**-2] * (basis.shape[1] - len(penalty)))
        coef = total.under(basis, scale).ridge(penalty)
        out.append(pd.DataFrame({"ds": pdf["ds"].to_numpy()[tested], "y": y[tested], "yhat": design[tested] @ (basis @ coef) * scale, "cutoff": pd.Timestamp(cutoff)}))
    return out


def row_folds(
    pdf: pd.DataFrame, cutoffs: Sequence[np.datetime64], horizon: int, mode: str, prior: float, regressors: Sequence[str], terms: Terms
) -> list[pd.DataFrame]:
    """The same by a fit from rows for each fold, for either mode."""
    dates, out = pdf["ds"].to_numpy("datetime64[D]"), []
    for cutoff in cutoffs:
        seen = pdf[dates <= cutoff + np.timedelta64(horizon, "D")]
        seen = seen.assign(mode=mode, prior=prior, is_train=seen["ds"].to_numpy("datetime64[D]") <= cutoff)
        fitted = fit_series(seen, regressors, terms)
        out.append(fitted.loc[~fitted["is_train"], ["ds", "y", "yhat"]].assign(cutoff=pd.Timestamp(cutoff)))
    return out


_COLUMNS = ["config_id", "mode", "prior", "fold", "cutoff", "ds", "y", "yhat"]
_SCHEMA = "config_id int, mode string, prior double, fold int, cutoff date, ds date, y double, yhat double"


def validate_series(
    pdf: pd.DataFrame, grid: Sequence[tuple[int, str, float]], regressors: Sequence[str], terms: Terms, horizon: int = 30, period: int = 15, reach: int = 60
) -> pd.DataFrame:
    """Test rows of every candidate as fold 0, and of the best one's folds as 1, 2, ..."""
    pdf = pdf.sort_values("ds", ignore_index=True)
    train = pdf["is_train"].fillna(False).to_numpy(bool)
    out, best = [], None
    for config_id, mode, prior in grid:
        try:
            fitted = fit_series(pdf.assign(mode=mode, prior=prior), regressors, terms)
        except (np.linalg.LinAlgError, ValueError, FloatingPointError):
            continue
        tested = fitted.loc[~train & fitted["y"].notna().to_numpy(), ["ds", "y", "yhat"]]
        out.append(tested.assign(config_id=config_id, mode=mode, prior=prior, fold=0, cutoff=pd.NaT))
        y, yhat = tested["y"].to_numpy(float), tested["yhat"].to_numpy(float)
        mape = np.mean(np.abs(y - yhat) / np.maximum(y, 1e-8)) if len(y) else np.nan
        if np.isfinite(mape) and (best is None or (mape, config_id) < best[:2]):
            best = (mape, config_id, mode, prior)
    if best is not None and train.any():
        _, config_id, mode, prior = best
        history = pdf[train].reset_index(drop=True)
        last = history["ds"].to_numpy("datetime64[D]").max()
        cutoffs = [last - np.timedelta64(d, "D") for d in range(reach, horizon - 1, -period)]
        try:
            if mode == "additive":
                folds = additive_folds(history, cutoffs, horizon, prior, regressors, terms)
            else:
                folds = row_folds(history, cutoffs, horizon, mode, prior, regressors, terms)
        except (np.linalg.LinAlgError, ValueError, FloatingPointError):
            folds = []
        for f in folds:
            if not len(f):
                continue
            number = 1 + cutoffs.index(f["cutoff"].iloc[0].to_datetime64().astype("datetime64[D]"))
            out.append(f.assign(config_id=config_id, mode=mode, prior=prior, fold=number))
    out = [o.assign(cutoff=o["cutoff"].astype("datetime64[s]")) for o in out if len(o)]
    if not out:
        return pd.DataFrame(columns=_COLUMNS)
    made = pd.concat(out, ignore_index=True)[_COLUMNS]
    return made.assign(cutoff=made["cutoff"].dt.date.where(made["cutoff"].notna(), None))


def cross_validate(
    frame: DataFrame,
    grid: Sequence[Config] = DEFAULT_GRID,
    key: str = "symbol",
    regressors: Sequence[str] = REGRESSORS,
    terms: Terms = Terms(),
    tasks: int | None = None,
) -> DataFrame:
    """(key, config, fold, cutoff, ds, y, yhat): test predictions of all candidates and folds of the best, in one pass.

    ``frame`` needs ds, y, is_train, event_keys and the regressors. A series is shuffled once.
    """
    require_columns(frame, [key, "ds", "y", "is_train", "event_keys", *regressors], "cross_validate")
    spark = frame.sparkSession
    tasks = tasks or max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = frame.select(key, "ds", "y", "is_train", "event_keys", *regressors).repartition(tasks, key)
    candidates, regressors = tuple((c.config_id, c.mode, c.prior) for c in grid), list(regressors)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return validate_series(pdf, candidates, regressors, terms).assign(**{key: pdf[key].iloc[0]})[[key, *_COLUMNS]]

    schema = T.StructType([frame.schema[key], *T._parse_datatype_string(_SCHEMA).fields])
    return spread.groupBy(key).applyInPandas(run, schema)


def cv_summary(validated: DataFrame, key: str = "symbol") -> DataFrame:
    """Per series the best candidate, its test metrics, its cross-validated error and number of folds."""
    candidate = (key, "config_id", "mode", "prior")
    in_test, in_fold = F.col("fold") == 0, (F.col("fold") > 0) & F.col("yhat").isNotNull()
    rows = with_errors(validated)
    # One aggregation for both: what isn't a test row is NULL to the metrics, and the other way round.
    tested = rows.withColumns({c: F.when(in_test, F.col(c)) for c in ("error", "abs_error", "pct_error")})
    more = [
        F.avg(F.when(in_fold, pct_error("y", "yhat"))).alias("cv_mape"),
        F.count_distinct(F.when(in_fold, F.col("fold"))).alias("folds"),
    ]
    return best_config(forecast_metrics(tested, candidate, more=more), key)
