"""Forecast frames, splits, folds, scores; the fit itself has no SQL twin.

Scoring queries run on a stand-in prediction SQL can repeat: under candidate k, a day is
predicted by the value k days earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.catalog.inputs import EVENTS, FILLED_MA, daily_filled, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.catalog.reporting import PCT_SCALE
from tidemark.forecast import (
    DEFAULT_GRID,
    best_config,
    cross_validate,
    cv_summary,
    event_features,
    fold_sizes,
    forecast,
    forecast_errors,
    forecast_metrics,
    frame_of,
    future_frame,
    model_frame,
    shift_regressors,
    split_by_time,
    with_configs,
    with_folds,
)
from tidemark.operators import reports
from tidemark.operators.normalize import model_input


def _frame(t: Tables) -> DataFrame:
    return frame_of(daily_filled(t))


FRAME = "frame as (select date as ds, symbol, daily_close as y, ma7, ma30 from filled_ma)"
SPLIT = f"""{FRAME},
split as (
  select *, row_number() over (partition by symbol order by ds) <= floor(count(*) over (partition by symbol) * 0.8::double) as is_train
  from frame)"""
GRID = "grid as (select * from (values " + ", ".join(
    f"({c.config_id}, '{c.mode}', {c.prior}::double)" for c in DEFAULT_GRID
) + ") g(config_id, mode, prior))"
STANDIN = f"""{SPLIT}, {GRID},
pred as (
  select symbol, ds, config_id, is_train,
         lag(y, config_id) over (partition by symbol, config_id order by ds) as yhat
  from split cross join grid),
errors as (
  select p.symbol, p.ds, config_id, yhat, y, y - yhat as error, abs(y - yhat) as abs_error,
         abs(y - yhat) / greatest(y, 1e-8) * 100.0::double as pct_error
  from pred p left join frame using (symbol, ds) where not is_train),
metrics as (
  select symbol, config_id,
         cast(sum(cast(error * error as decimal(38,4))) as double) / count(error) as mse,
         cast(sum(cast(pct_error as decimal(18,6))) as double) / count(error) as mape,
         cast(sum(cast(abs_error as decimal(18,2))) as double) / count(error) as mae,
         count(error) as n
  from errors group by 1, 2),
scored as (select symbol, config_id, round(mse, 2) as mse, mape, mae, n, round(sqrt(mse), 4) as rmse from metrics)"""


def _standin_errors(t: Tables) -> DataFrame:
    split = with_configs(split_by_time(_frame(t)))
    days = Window.partitionBy("symbol", "config_id").orderBy("ds")
    lags = [F.when(F.col("config_id") == c.config_id, F.lag("y", c.config_id).over(days)) for c in DEFAULT_GRID]
    predicted = split.withColumn("yhat", F.coalesce(*lags)).filter(~F.col("is_train"))
    return forecast_errors(predicted.select("symbol", "ds", "config_id", "yhat"), _frame(t))


def _standin_metrics(t: Tables) -> DataFrame:
    metrics = forecast_metrics(_standin_errors(t), by=("symbol", "config_id"), scale=PCT_SCALE)
    # Sums of squares exceed the exact integers of a double; both sides round alike.
    return metrics.withColumns({"mse": F.round("mse", 2), "rmse": F.round("rmse", 4)})


@query("model_frame", sql_with(*FILLED_MA, body=f", {FRAME} select * from frame"))
def model_frame_rows(t: Tables) -> DataFrame:
    filled = daily_filled(t)
    return model_frame(model_input(filled), filled)


@query("train_test_split", sql_with(*FILLED_MA, body=f", {SPLIT} select symbol, ds, y, is_train from split"))
def train_test_split(t: Tables) -> DataFrame:
    return split_by_time(_frame(t)).select("symbol", "ds", "y", "is_train")


@query(
    "event_features",
    sql_with(
        *FILLED_MA,
        body=f""", {FRAME},
events_in as (select * from (values {", ".join(f"('{e.symbol}', '{e.name}', date '{e.day}')" for e in EVENTS)}) v(symbol, name, day)),
event_days as (
  select symbol, name || '_' || o as k, cast(day + cast(o as integer) as date) as ds from events_in, range(-7, 8) r(o))
select f.symbol, f.ds, coalesce(string_agg(k, ',' order by k), '') as event_keys
from frame f left join event_days e on f.symbol = e.symbol and f.ds = e.ds group by 1, 2""",
    ),
)
def event_feature_rows(t: Tables) -> DataFrame:
    marked = event_features(_frame(t), EVENTS)
    return marked.select("symbol", "ds", F.array_join("event_keys", ",").alias("event_keys"))


@query(
    "param_grid",
    sql_with(
        *FILLED_MA,
        body=f""", {GRID}, series as (select symbol, count(*) as days from filled_ma group by 1)
select * from series cross join grid""",
    ),
)
def param_grid(t: Tables) -> DataFrame:
    return with_configs(daily_filled(t).groupBy("symbol").agg(F.count(F.lit(1)).alias("days")))


@query(
    "future_frame",
    sql_with(
        *FILLED_MA,
        body=f""", {FRAME},
days as (
  select symbol, cast(unnest(generate_series(min(ds), max(ds) + 30, interval 1 day)) as date) as ds from frame group by 1),
grown as (
  select symbol, ds, y, y is null as is_future,
         coalesce(last_value(ma7 ignore nulls) over w, 0) as ma7, coalesce(last_value(ma30 ignore nulls) over w, 0) as ma30
  from days left join frame using (symbol, ds)
  window w as (partition by symbol order by ds rows unbounded preceding))
select symbol, ds, y, is_future, coalesce(lag(ma7) over v, 0) as ma7, coalesce(lag(ma30) over v, 0) as ma30
from grown window v as (partition by symbol order by ds)""",
    ),
)
def future_frame_rows(t: Tables) -> DataFrame:
    return shift_regressors(future_frame(_frame(t), horizon=30), "lagged")


@query("forecast_errors", sql_with(*FILLED_MA, body=f", {STANDIN} select * from errors"))
def forecast_error_rows(t: Tables) -> DataFrame:
    return _standin_errors(t)


@query("forecast_metrics", sql_with(*FILLED_MA, body=f", {STANDIN} select * from scored"))
def forecast_metric_rows(t: Tables) -> DataFrame:
    return _standin_metrics(t)


BEST = """select * from (
  select * from scored
  qualify row_number() over (partition by symbol order by mape, config_id) = 1)"""


@query("best_config", sql_with(*FILLED_MA, body=f", {STANDIN} {BEST}"))
def best_config_rows(t: Tables) -> DataFrame:
    return best_config(_standin_metrics(t))


@query(
    "model_kpis",
    sql_with(
        *FILLED_MA,
        body=f""", {STANDIN}, best as ({BEST})
select count(*) as n_symbols, cast(sum(cast(mape as decimal(18,6))) as double) / count(*) as mean_mape,
       arg_min(symbol, row(mape, symbol)) as best_symbol from best""",
    ),
)
def model_kpis(t: Tables) -> DataFrame:
    return reports.model_kpis(best_config(_standin_metrics(t)), scale=PCT_SCALE)


def _chosen_errors(t: Tables) -> DataFrame:
    """Errors of each series under its best candidate."""
    chosen = best_config(_standin_metrics(t)).select("symbol", "config_id")
    return _standin_errors(t).join(chosen, ["symbol", "config_id"])


CHOSEN = f"{STANDIN}, best as (select symbol, config_id from ({BEST}))"


@query(
    "error_histogram",
    sql_with(
        *FILLED_MA,
        body=f""", {CHOSEN}
select symbol, cast(case when pct_error < 0 then 0 when pct_error >= 100 then 21
                         else floor(pct_error / 100.0::double * 20) + 1 end as bigint) as bin, count(*) as n
from errors join best using (symbol, config_id) where errors.pct_error is not null group by 1, 2""",
    ),
)
def error_histogram(t: Tables) -> DataFrame:
    return reports.error_histogram(_chosen_errors(t), 0, 100, 20)


@query(
    "recent_predictions",
    sql_with(
        *FILLED_MA,
        body=f""", {CHOSEN}
select symbol, ds, yhat, y, error, abs_error, pct_error from errors join best using (symbol, config_id)
qualify row_number() over (partition by symbol order by ds desc) <= 30""",
    ),
)
def recent_predictions(t: Tables) -> DataFrame:
    return reports.last_n(_chosen_errors(t).drop("config_id"), 30, date="ds")


@query(
    "cv_folds",
    sql_with(
        *FILLED_MA,
        body=f""", {SPLIT},
ends as (select symbol, max(ds) as last_day from split where is_train group by 1),
folds as (
  select symbol, cast(i + 1 as integer) as fold, cast(last_day - 60 + 15 * cast(i as integer) as date) as cutoff from ends, range(0, 3) r(i))
select symbol, fold, cutoff, count(*) filter (ds <= cutoff) as train_rows, count(*) filter (ds > cutoff) as test_rows
from folds join split using (symbol) where is_train and ds <= cutoff + 30 group by 1, 2, 3""",
    ),
)
def cv_folds(t: Tables) -> DataFrame:
    return fold_sizes(with_folds(split_by_time(_frame(t))))


def _training_frame(t: Tables) -> DataFrame:
    """Model frame with split, future rows, lagged regressors and event keys."""
    grown = future_frame(split_by_time(_frame(t)), horizon=30)
    ready = shift_regressors(grown, "lagged").withColumn("is_train", F.coalesce("is_train", F.lit(False)))
    return event_features(ready, EVENTS)


@query("forecast")
def forecast_rows(t: Tables) -> DataFrame:
    return forecast(_training_frame(t), by=("symbol",), grid=DEFAULT_GRID)


@query("cv_metrics")
def cv_metrics(t: Tables) -> DataFrame:
    """Best candidate per series with its test metrics and cross-validated error, all fits in one pass."""
    return cv_summary(cross_validate(_training_frame(t), DEFAULT_GRID))
