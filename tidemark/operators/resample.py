"""Bars and ticks to open/high/low/close buckets; one aggregation, no self-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_mean, exact_sum, ordering
from tidemark.schemas import require_columns

VOLUME_MODES = ("sum", "last")

# The output names below (daily_open ... avg_price, cnt, total_trades, tick_count) are
# the column contract of every daily table.


def bar_aggregates(order_by: Sequence[str | Column], scale: int | None = None) -> list[Column]:
    """Daily OHLCV and row count from bars, first and last taken in the stated order."""
    order = ordering(order_by)
    return [
        F.min_by("open", order).alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        F.max_by("close", order).alias("daily_close"),
        exact_sum("volume", scale).alias("daily_volume"),
        F.count(F.lit(1)).alias("cnt"),
    ]


def tick_aggregates(
    order_by: Sequence[str | Column], volume_mode: str = "sum", scale: int | None = None
) -> list[Column]:
    """Daily figures from ticker messages.

    Ticker volumes are rolling 24-hour totals: ``volume_mode="last"`` takes the latest one,
    ``"sum"`` adds all of them up as the message flow does.
    """
    if volume_mode not in VOLUME_MODES:
        raise ValueError(f"volume_mode must be one of {VOLUME_MODES}")
    order = ordering(order_by)

    def total(column: str, exact: int | None) -> Column:
        return exact_sum(column, exact) if volume_mode == "sum" else F.max_by(column, order)

    return [
        F.min_by("open", order).alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        F.max_by("price", order).alias("daily_close"),
        total("volume", scale).alias("daily_volume"),
        total("quote_volume", scale).alias("daily_quote_volume"),
        (F.sum("number_trades") if volume_mode == "sum" else F.max_by("number_trades", order))
        .cast("bigint")
        .alias("total_trades"),
        F.count(F.lit(1)).alias("tick_count"),
        exact_mean("price", scale).alias("avg_price"),
    ]


def partial_ticks(order_by: Sequence[str | Column], volume_mode: str = "sum", scale: int | None = None) -> list[Column]:
    """Aggregates that :func:`merge_ticks` adds up to those of :func:`tick_aggregates`.

    First and last rows carry their place in the order, means their sum and count, exact sums
    stay decimals.
    """
    if volume_mode not in VOLUME_MODES:
        raise ValueError(f"volume_mode must be one of {VOLUME_MODES}")
    order = ordering(order_by)
    exact = lambda c: F.col(c) if scale is None else F.col(c).cast(f"decimal(18,{scale})")
    by_sum = volume_mode == "sum"
    out = [
        F.min(order).alias("first_at"),
        F.max(order).alias("last_at"),
        F.min_by("open", order).alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        F.max_by("price", order).alias("daily_close"),
        F.lit(by_sum).alias("by_sum"),
    ]
    for column, name in (("volume", "daily_volume"), ("quote_volume", "daily_quote_volume")):
        out.append((F.sum(exact(column)) if by_sum else F.max_by(column, order)).alias(name))
    trades = F.sum("number_trades") if by_sum else F.max_by("number_trades", order)
    return [
        *out,
        trades.cast("bigint").alias("total_trades"),
        F.count(F.lit(1)).alias("tick_count"),
        F.sum(exact("price")).alias("price_sum"),
        F.count("price").alias("price_count"),
    ]


def merge_ticks(parts: DataFrame, keys: Sequence[str], more: Sequence[Column] = (), finish: bool = True) -> DataFrame:
    """Rows of :func:`partial_ticks` to one per key; with ``finish`` under the names of :func:`tick_aggregates`.

    Without it the result is partial again, and can be merged further. Both forms don't depend on how
    ticks were dealt to parts, exact sums not even in the last digit.
    """
    # No part mixes the two ways to take volumes.
    total = lambda c: F.when(F.any_value("by_sum"), F.sum(c)).otherwise(F.max_by(c, "last_at"))
    merged = parts.groupBy(*keys).agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min_by("daily_open", "first_at").alias("daily_open"),
        F.max("daily_high").alias("daily_high"),
        F.min("daily_low").alias("daily_low"),
        F.max_by("daily_close", "last_at").alias("daily_close"),
        F.any_value("by_sum").alias("by_sum"),
        *[total(c).cast(parts.schema[c].dataType).alias(c) for c in ("daily_volume", "daily_quote_volume", "total_trades")],
        F.sum("tick_count").alias("tick_count"),
        F.sum("price_sum").cast(parts.schema["price_sum"].dataType).alias("price_sum"),
        F.sum("price_count").alias("price_count"),
        *more,
    )
    if not finish:
        return merged
    mean = F.try_divide(F.col("price_sum").cast("double"), F.col("price_count").cast("double"))
    volumes = [F.col(c).cast("double").alias(c) for c in ("daily_volume", "daily_quote_volume")]
    prices = ("daily_open", "daily_high", "daily_low", "daily_close")
    return merged.select(*keys, *prices, *volumes, "total_trades", "tick_count", mean.alias("avg_price"))


def daily_bars(
    bars: DataFrame, day: Column, order_by: Sequence[str | Column], key: str = "symbol", scale: int | None = None
) -> DataFrame:
    """Daily OHLCV per (key, day). Rows combine before the shuffle, so hot days stay small."""
    require_columns(bars, [key, "open", "high", "low", "close", "volume"], "daily_bars")
    return bars.groupBy(key, day.alias("date")).agg(*bar_aggregates(order_by, scale))


def daily_ticks(
    messages: DataFrame,
    order_by: Sequence[str | Column] = ("event_timestamp",),
    key: str = "symbol",
    volume_mode: str = "sum",
    scale: int | None = None,
) -> DataFrame:
    """The bounded twin of the streaming daily aggregate: same columns, same order rule."""
    require_columns(messages, [key, "date", "price"], "daily_ticks")
    return messages.groupBy("date", key).agg(*tick_aggregates(order_by, volume_mode, scale))


def daily_bars_by_join(
    bars: DataFrame, day: Column, ts: str = "timestamp", key: str = "symbol", scale: int | None = None
) -> DataFrame:
    """The join formulation of :func:`daily_bars`, for bars that are unique per (key, ts).

    The daily totals carry the first and last stamp; joining the bars back on equality with
    either finds the opening and closing bar, and a left join attaches them. The totals are
    small, so AQE broadcasts them when they measure so, and splits hot days otherwise.
    It shuffles raw rows where :func:`daily_bars` shuffles sums: a cross-check, no job uses it.
    """
    dated = bars.withColumn("date", day)
    on = [key, "date"]
    totals = dated.groupBy(*on).agg(
        F.min(ts).alias("_min"),
        F.max(ts).alias("_max"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        exact_sum("volume", scale).alias("daily_volume"),
        F.count(F.lit(1)).alias("cnt"),
    )
    at_min, at_max = F.col(ts) == F.col("_min"), F.col(ts) == F.col("_max")
    edges = dated.select(*on, ts, "open", "close").join(totals.select(*on, "_min", "_max"), on).filter(at_min | at_max)
    ends = edges.groupBy(*on).agg(
        F.max(F.when(at_min, F.col("open"))).alias("daily_open"),
        F.max(F.when(at_max, F.col("close"))).alias("daily_close"),
    )
    return totals.drop("_min", "_max").join(ends, on, "left")
