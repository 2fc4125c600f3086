"""Model frames: features joined to the target, time split, future rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.calendar import densify
from tidemark.schemas import require_columns

REGRESSORS = ("ma7", "ma30")
REGRESSOR_TIMING = ("lagged", "same_day")


def model_frame(inputs: DataFrame, daily: DataFrame, regressors: Sequence[str] = REGRESSORS) -> DataFrame:
    """(ds, y, symbol) left-joined with the regressors of the daily table."""
    require_columns(inputs, ["ds", "y", "symbol"], "model_frame")
    require_columns(daily, ["date", "symbol", *regressors], "model_frame")
    features = daily.select(F.col("date").alias("ds"), "symbol", *regressors)
    return inputs.select("ds", "y", "symbol").join(features, ["ds", "symbol"], "left")


def frame_of(daily: DataFrame, regressors: Sequence[str] = REGRESSORS) -> DataFrame:
    """The model frame of one daily table that holds target and regressors: no join needed."""
    require_columns(daily, ["date", "symbol", "daily_close", *regressors], "frame_of")
    return daily.select(F.col("date").alias("ds"), "symbol", F.col("daily_close").alias("y"), *regressors)


def split_by_time(frame: DataFrame, fraction: float = 0.8, key: str = "symbol", ds: str = "ds") -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows of each series as training rows."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(ds))
    size = F.count(F.lit(1)).over(Window.partitionBy(key))
    return frame.withColumn("is_train", position <= F.floor(size * F.lit(fraction)))


def future_frame(
    frame: DataFrame, horizon: int = 30, regressors: Sequence[str] = REGRESSORS, key: str = "symbol", ds: str = "ds"
) -> DataFrame:
    """History plus ``horizon`` days; regressors carried forward, zero where nothing precedes.

    ``is_future`` marks the days behind the last actual one; a hole inside the history is a day
    without a value, not a future one.
    """
    grown = densify(frame, carry=regressors, key=key, date=ds, extend_days=horizon)
    last = F.max(F.when(~F.col("is_filled"), F.col(ds))).over(Window.partitionBy(key))
    future = grown.withColumn("is_future", F.col(ds) > last).drop("is_filled")
    return future.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in regressors})


def shift_regressors(
    frame: DataFrame, timing: str = "lagged", regressors: Sequence[str] = REGRESSORS, key: str = "symbol", ds: str = "ds"
) -> DataFrame:
    """``lagged``: each day sees the previous day's averages. ``same_day`` leaves them in place,
    although such an average already contains the value to be predicted."""
    if timing not in REGRESSOR_TIMING:
        raise ValueError(f"timing must be one of {REGRESSOR_TIMING}")
    if timing == "same_day":
        return frame
    ordered = Window.partitionBy(key).orderBy(ds)
    return frame.withColumns({c: F.coalesce(F.lag(c).over(ordered), F.lit(0.0)) for c in regressors})
