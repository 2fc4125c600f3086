"""Forecast training: candidates, hold-out scores, choice, cross-validation, outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.forecast import (
    DEFAULT_GRID,
    Config,
    Event,
    cross_validate,
    cv_summary,
    event_features,
    event_table_features,
    forecast,
    future_frame,
    model_frame,
    shift_regressors,
    split_by_time,
    with_errors,
)
from tidemark.plans.layout import Layout
from tidemark.plans.serving import read_daily, read_model_input
from tidemark.sinks import materialize, read_version, write_csv, write_version

HORIZON = 30
CONFIG = ("config_id", "mode", "prior")
SERIES_ORDER = ("symbol", "ds")


def training_frame(frame: DataFrame, events: Sequence[Event] | DataFrame, timing: str = "lagged") -> DataFrame:
    """History, test range and future days of every series, ready to fit; events from a list or a table."""
    grown = future_frame(split_by_time(frame.dropna(subset=["y"])), HORIZON)
    ready = shift_regressors(grown, timing).withColumn("is_train", F.coalesce("is_train", F.lit(False)))
    return event_table_features(ready, events) if isinstance(events, DataFrame) else event_features(ready, events)


def train(
    spark: SparkSession,
    layout: Layout,
    events: Sequence[Event] | DataFrame = (),
    grid: Sequence[Config] = DEFAULT_GRID,
    timing: str = "lagged",
) -> None:
    """Try all candidates of all series, keep the best, score it and store its fit.

    All candidates and folds of a series are fitted in one pass, of which only the scores are
    stored; the rows of the chosen candidate's fit are made once. Series that no candidate fits go to a table of their own.
    Earlier results stay as the previous version of each table.
    """
    frame = model_frame(read_model_input(spark, layout), read_daily(spark, layout))
    ready = training_frame(frame, events, timing)
    # Read by the candidates, the chosen fit and the list of what has none: stored, so it is computed once.
    ready = materialize(ready, "training-frame")
    metrics = materialize(cv_summary(cross_validate(ready, grid)), "candidate-scores")
    chosen = metrics.select("symbol", *CONFIG)
    fitted = forecast(ready.join(chosen, "symbol"), by=("symbol", "config_id"))
    write_version(fitted, layout.model("forecasts"), (), cluster_by=SERIES_ORDER)

    stored = read_version(spark, layout.model("forecasts"))
    actual = with_errors(stored.filter(~F.col("is_train") & F.col("y").isNotNull()))
    write_csv(actual.select("symbol", "ds", "yhat", "y", "error", "abs_error", "pct_error"), layout.model("actual_vs_pred"))
    write_csv(metrics, layout.model("metrics"))
    write_csv(ready.select("symbol").distinct().join(chosen, "symbol", "left_anti"), layout.model("unfitted"))
