"""Full calendars, gap-free daily series and moving averages.

Windows here are per series over *daily* rows, so the longest one is bounded by the days in
the covered span and not by the amount of raw data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact_sum
from tidemark.schemas import DAILY_OHLC, require_columns

VOLUME_POLICIES = ("zero", "carry")


def calendar_spine(daily: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Every (key, date) between the first and the last date of each series."""
    span = daily.groupBy(key).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    return span.select(key, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(date))


def missing_days(daily: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Calendar days without a row, read off the holes between neighbouring dates: no join."""
    following = F.lead(date).over(Window.partitionBy(key).orderBy(date))
    holes = daily.select(key, F.col(date).alias("_from"), following.alias("_to"))
    holes = holes.filter(F.datediff("_to", "_from") > 1)
    days = F.sequence(F.date_add("_from", 1), F.date_sub("_to", 1), F.expr("interval 1 day"))
    return holes.select(F.explode(days).alias(date), key)


def densify(
    daily: DataFrame,
    carry: Sequence[str],
    fill: Mapping[str, float | int] | None = None,
    key: str = "symbol",
    date: str = "date",
    until: Column | None = None,
    extend_days: int = 0,
) -> DataFrame:
    """One row per calendar day, unique (key, date) in.

    ``carry`` columns hold their last known value on added days, ``fill`` columns get a
    constant there, all other columns are NULL there; ``is_filled`` marks the added days.
    Each row simply covers the days up to its successor, so the calendar, the left join and
    the forward fill are one window and one generator on a single shuffle. The last row of a
    series reaches to ``until`` (rows after it are left out) plus ``extend_days``.
    """
    fill = dict(fill or {})
    require_columns(daily, [key, date, *carry, *fill], "densify")
    if until is not None:
        daily = daily.filter(F.col(date) <= until)
    ordered = Window.partitionBy(key).orderBy(date)
    end = F.col(date) if until is None else until
    past = ordered.rowsBetween(Window.unboundedPreceding, 0)
    others = [c for c in daily.columns if c not in {key, date, *carry, *fill}]
    covered = daily.select(
        key,
        F.col(date).alias("_from"),
        F.coalesce(F.date_sub(F.lead(date).over(ordered), 1), F.date_add(end, extend_days)).alias("_to"),
        *[F.last(c, ignorenulls=True).over(past).alias(c) for c in carry],
        *fill,
        *others,
    )
    spread = covered.select("*", F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias(date))
    is_filled = F.col(date) > F.col("_from")
    return spread.select(
        key,
        date,
        *carry,
        *[
            F.when(is_filled, F.lit(v)).otherwise(F.coalesce(F.col(c), F.lit(v))).cast(daily.schema[c].dataType).alias(c)
            for c, v in fill.items()
        ],
        *[F.when(~is_filled, F.col(c)).alias(c) for c in others],
        is_filled.alias("is_filled"),
    )


def fill_calendar(
    daily: DataFrame, volume_policy: str = "zero", key: str = "symbol", until: Column | None = None
) -> DataFrame:
    """Gap-free daily OHLCV: prices carried; volume zero or carried; days without a price dropped."""
    if volume_policy not in VOLUME_POLICIES:
        raise ValueError(f"volume_policy must be one of {VOLUME_POLICIES}")
    carry, fill = list(DAILY_OHLC), {"daily_volume": 0.0}
    if volume_policy == "carry":
        carry, fill = [*carry, "daily_volume"], {}
    if "cnt" in daily.columns:
        fill["cnt"] = 0
    return densify(daily, carry, fill, key=key, until=until).filter(F.col("daily_close").isNotNull())


def moving_averages(
    df: DataFrame,
    value: str = "daily_close",
    windows: Sequence[int] = (7, 30),
    key: str = "symbol",
    date: str = "date",
    min_periods: int | None = None,
    scale: int | None = None,
) -> DataFrame:
    """``ma<n>``: mean of the last n rows. Short heads give partial means unless ``min_periods``."""
    require_columns(df, [key, date, value], "moving_averages")
    ordered = Window.partitionBy(key).orderBy(date)
    added = {}
    for n in windows:
        frame = ordered.rowsBetween(1 - n, 0)
        known = F.count(value).over(frame)
        if scale is None:
            mean = F.avg(value).over(frame)
        else:
            total = F.sum(F.col(value).cast(f"decimal(18,{scale})")).over(frame).cast("double")
            mean = F.try_divide(total, known.cast("double"))
        added[f"ma{n}"] = F.when(known >= min_periods, mean) if min_periods else mean
    return df.withColumns(added)


def period_mean(
    df: DataFrame, value: str, period: Column, name: str, alias: str, key: str = "symbol", scale: int | None = None
) -> DataFrame:
    """Mean of ``value`` per (key, period), such as a month or a year."""
    total = exact_sum(value, scale)
    return df.groupBy(key, period.alias(name)).agg(F.try_divide(total, F.count(value).cast("double")).alias(alias))
