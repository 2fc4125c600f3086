"""The fit itself against SQL: its accounts, and its line where only a line is fitted."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.catalog.forecasts import GRID, SPLIT, _frame, _training_frame
from tidemark.catalog.inputs import FILLED_MA, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.forecast import DEFAULT_GRID, forecast, forecast_metrics, split_by_time, with_errors, with_folds
from tidemark.forecast.fit import COMPONENTS, LINEAR, Terms
from tidemark.functions import exact_mean, pct_error

@query(
    "forecast_audit",
    sql_with(
        *FILLED_MA,
        body=f""", {SPLIT}, {GRID}
select symbol, config_id, mode, prior, count(*) + 30 as rows, count(*) filter (is_train) as train_rows,
       count(*) filter (not is_train) as test_rows, cast(30 as bigint) as future_rows, 'ok' as status, 'yearly,weekly' as seasons,
       true as adds_up, true as ordered
from split cross join grid group by 1, 2, 3, 4""",
    ),
)
def forecast_audit(t: Tables) -> DataFrame:
    """Per series and candidate: rows of each kind, components that add up, bounds in order."""
    fits = forecast(_training_frame(t), by=("symbol",), grid=DEFAULT_GRID)
    total = sum((F.col(c) for c in COMPONENTS[1:]), F.col(COMPONENTS[0]))
    known = F.col("y").isNotNull()
    return fits.groupBy("symbol", "config_id", "mode", "prior").agg(
        F.count("*").alias("rows"),
        F.count_if("is_train").alias("train_rows"),
        F.count_if(~F.col("is_train") & known).alias("test_rows"),
        F.count_if(~known).alias("future_rows"),
        F.max("status").alias("status"),
        F.max("seasons").alias("seasons"),
        F.every(F.abs(total - F.col("yhat")) <= 1e-6 * F.greatest(F.abs("yhat"), F.lit(1.0))).alias("adds_up"),
        F.every(F.col("yhat_lower") <= F.col("yhat_upper")).alias("ordered"),
    )


def _linear(frame: DataFrame, by: tuple[str, ...], terms: Terms = LINEAR) -> DataFrame:
    bare = frame.withColumns({"event_keys": F.array().cast("array<string>"), "mode": F.lit("additive"), "prior": F.lit(0.05)})
    return forecast(bare, by=by, terms=terms)


@query(
    "forecast_linear",
    sql_with(
        *FILLED_MA,
        body=f""", {SPLIT},
days as (select *, cast(date_diff('day', date '1990-01-01', ds) as double) as x from split),
line as (select symbol, regr_slope(y, x) as a, regr_intercept(y, x) as b from days where is_train group by 1)
select symbol, ds, is_train, round(a * x + b, 1) as yhat from days join line using (symbol)""",
    ),
)
def forecast_linear(t: Tables) -> DataFrame:
    """Offset and slope alone, without penalty: the ordinary least-squares line."""
    fits = _linear(split_by_time(_frame(t)), ("symbol",))
    return fits.select("symbol", "ds", "is_train", F.round("yhat", 1).alias("yhat"))


@query(
    "cv_metrics_linear",
    sql_with(
        *FILLED_MA,
        body=f""", {SPLIT},
days as (select *, cast(date_diff('day', date '1990-01-01', ds) as double) as x from split),
line as (select symbol, regr_slope(y, x) as a, regr_intercept(y, x) as b from days where is_train group by 1),
test as (
  select symbol, avg(abs(y - (a * x + b)) / greatest(y, 1e-8) * 100.0::double) as mape from days join line using (symbol) where not is_train group by 1),
ends as (select symbol, max(ds) as last_day from days where is_train group by 1),
folds as (select symbol, i as fold, cast(last_day - 60 + 15 * cast(i as integer) as date) as cutoff from ends, range(0, 3) r(i)),
part as (select d.*, fold, ds <= cutoff as fits from days d join folds using (symbol) where is_train and ds <= cutoff + 30),
fold_line as (select symbol, fold, regr_slope(y, x) as a, regr_intercept(y, x) as b from part where fits group by 1, 2),
cv as (
  select symbol, avg(abs(y - (a * x + b)) / greatest(y, 1e-8) * 100.0::double) as cv_mape, count(distinct fold) as folds
  from part join fold_line using (symbol, fold) where not fits group by 1)
select symbol, round(mape, 4) as mape, round(cv_mape, 4) as cv_mape, folds from test join cv using (symbol)""",
    ),
)
def cv_metrics_linear(t: Tables) -> DataFrame:
    """Test error beside cross-validated error per series, for the line."""
    split = split_by_time(_frame(t))
    tested = _linear(split, ("symbol",)).filter(~F.col("is_train"))
    test = forecast_metrics(with_errors(tested)).select("symbol", F.round("mape", 4).alias("mape"))
    folds = _linear(with_folds(split), ("symbol", "fold")).filter(~F.col("is_train") & F.col("yhat").isNotNull())
    cv = folds.groupBy("symbol").agg(F.round(exact_mean(pct_error("y", "yhat"), None), 4).alias("cv_mape"), F.count_distinct("fold").alias("folds"))
    return test.join(cv, "symbol")


# Trend changes per length of the history and their mean size (in units of the largest training value).
CHANGES = (25.0, 0.05)


@query(
    "interval_growth",
    sql_with(
        *FILLED_MA,
        body=f""", {SPLIT},
days as (select *, cast(date_diff('day', date '1990-01-01', ds) as double) as x from split),
line as (
  select symbol, regr_slope(y, x) as a, regr_intercept(y, x) as b, min(x) as first_x, max(x) as last_x, max(abs(y)) as scale
  from days where is_train group by 1),
fitted as (select d.*, l.* exclude (symbol), a * x + b as yhat, y - (a * x + b) as residual from days d join line l using (symbol)),
noise as (
  select symbol, quantile_cont(residual, 0.1) as low, quantile_cont(residual, 0.9) as high, stddev_pop(residual) as sd
  from fitted where is_train group by 1),
grown as (
  select f.*, low, high, sd, greatest((x - last_x) / (last_x - first_x), 0) as h from fitted f join noise using (symbol)),
wide as (
  select *, 1.2815515655446004 * (sqrt(sd * sd + {CHANGES[0]} * 2 * pow({CHANGES[1]} * scale, 2) * pow(h, 3) / 3) - sd) as wider from grown)
select symbol, ds, is_train, round(yhat + low - wider, 1) as yhat_lower, round(yhat + high + wider, 1) as yhat_upper,
       wider > 0.001 as is_wider from wide""",
    ),
)
def interval_growth(t: Tables) -> DataFrame:
    """Bounds of the line, which widen behind the training range by a stated rate and size of trend changes."""
    fits = _linear(split_by_time(_frame(t)), ("symbol",), replace(LINEAR, trend_changes=CHANGES))
    width = F.col("yhat_upper") - F.col("yhat_lower")
    at_first = F.min(width).over(Window.partitionBy("symbol"))
    bounds = [F.round(c, 1).alias(c) for c in ("yhat_lower", "yhat_upper")]
    return fits.select("symbol", "ds", "is_train", *bounds, (width - at_first > 0.002).alias("is_wider"))
