"""Errors, metrics and model choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_mean, pct_error
from tidemark.schemas import require_columns


def forecast_errors(predicted: DataFrame, actual: DataFrame, on: Sequence[str] = ("symbol", "ds")) -> DataFrame:
    """Predictions left-joined with actual values; error, abs_error and pct_error per row."""
    require_columns(predicted, [*on, "yhat"], "forecast_errors")
    return with_errors(predicted.drop("y").join(actual.select(*on, "y"), list(on), "left"))


def with_errors(df: DataFrame) -> DataFrame:
    """The error columns of a frame that holds y and yhat side by side."""
    error = F.col("y") - F.col("yhat")
    return df.withColumns({"error": error, "abs_error": F.abs(error), "pct_error": pct_error("y", "yhat")})


def forecast_metrics(
    errors: DataFrame, by: Sequence[str] = ("symbol",), scale: int | None = None, more: Sequence[Column] = ()
) -> DataFrame:
    """MSE, MAPE, MAE and RMSE per group, and ``more`` aggregates beside them.

    With ``scale`` sums run in 38-digit decimals: errors up to 1e15 and percentages of floored
    prices fit with six decimals.
    """
    square = F.pow("error", F.lit(2.0))
    means = errors.groupBy(*by).agg(
        exact_mean(square, scale, precision=38).alias("mse"),
        exact_mean("pct_error", scale, precision=38).alias("mape"),
        exact_mean("abs_error", scale, precision=38).alias("mae"),
        F.count("error").alias("n"),
        *more,
    )
    return means.withColumn("rmse", F.sqrt("mse"))


def best_config(metrics: DataFrame, key: str = "symbol") -> DataFrame:
    """The configuration with the smallest MAPE per series; ties go to the smaller id.

    Configurations without a score (failed fits) never win; a series without any is left out.
    """
    kept = [c for c in metrics.columns if c != key]
    scored = metrics.filter(F.col("mape").isNotNull() & ~F.isnan("mape"))
    best = scored.groupBy(key).agg(F.min_by(F.struct(*kept), F.struct("mape", "config_id")).alias("_best"))
    return best.select(key, "_best.*")


def cv_scores(fold_predictions: DataFrame, key: str = "symbol", scale: int | None = None) -> DataFrame:
    """Mean percentage error over the test rows of all folds of a series."""
    tested = fold_predictions.filter(~F.col("is_train") & F.col("yhat").isNotNull())
    return tested.groupBy(key).agg(
        exact_mean(pct_error("y", "yhat"), scale, precision=38).alias("cv_mape"), F.count_distinct("fold").alias("folds")
    )
