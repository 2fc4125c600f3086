"""Event-time windows over parsed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.resample import tick_aggregates
from tidemark.schemas import require_columns

EVENT_TIME = "event_timestamp"


def with_event_watermark(messages: DataFrame, delay: str = "1 hour", time: str = EVENT_TIME) -> DataFrame:
    """Accept rows up to ``delay`` behind the newest event time; NTZ columns are cast first."""
    require_columns(messages, [time], "with_event_watermark")
    return messages.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def windowed_bars(
    messages: DataFrame,
    size: str = "1 day",
    key: str = "symbol",
    order_by: Sequence[str | Column] = (EVENT_TIME,),
    volume_mode: str = "sum",
    scale: int | None = None,
    daily: bool = True,
    time: str = EVENT_TIME,
) -> DataFrame:
    """Tumbling-window bars per key, with the aggregates and order rule of the batch form.

    ``daily`` names the window start ``date`` and makes it a DATE, as in every daily table;
    otherwise it stays a timestamp called ``window_start``.
    """
    grouped = messages.groupBy(F.window(time, size).alias("window"), key)
    bars = grouped.agg(*tick_aggregates(order_by, volume_mode, scale))
    start = F.col("window.start")
    named = F.to_date(start).alias("date") if daily else start.alias("window_start")
    return bars.select(named, *[c for c in bars.columns if c != "window"])
