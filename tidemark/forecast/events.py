"""Event windows as indicator keys per (series, day)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import MAX_BROADCAST_ROWS


@dataclass(frozen=True)
class Event:
    """One occurrence; the days ``day + lower .. day + upper`` each get an indicator."""

    symbol: str
    name: str
    day: dt.date
    lower: int = -7
    upper: int = 7


# The events the daily price model knows.
HALVINGS = (
    Event("BTCUSDT", "btc_halving", dt.date(2016, 7, 9)),
    Event("BTCUSDT", "btc_halving", dt.date(2020, 5, 11)),
    Event("BTCUSDT", "btc_halving", dt.date(2024, 4, 20)),
)


def event_days(events: Sequence[Event]) -> dict[tuple[str, dt.date], list[str]]:
    """(symbol, day) -> sorted ``<name>_<offset>`` keys of all windows covering the day."""
    days: dict[tuple[str, dt.date], set[str]] = {}
    for e in events:
        for offset in range(e.lower, e.upper + 1):
            days.setdefault((e.symbol, e.day + dt.timedelta(days=offset)), set()).add(f"{e.name}_{offset}")
    return {k: sorted(v) for k, v in sorted(days.items())}


def event_features(frame: DataFrame, events: Sequence[Event], key: str = "symbol", ds: str = "ds") -> DataFrame:
    """Add ``event_keys``: the event days' indicator keys, empty on ordinary days.

    The event list is configuration, so its days are laid out on the driver; they are
    broadcast up to a fixed number of rows and joined like any table beyond it.
    """
    none = F.array().cast("array<string>")
    if not events:
        return frame.withColumn("event_keys", none)
    rows = [(symbol, day, keys) for (symbol, day), keys in event_days(events).items()]
    days = frame.sparkSession.createDataFrame(rows, f"{key} string, {ds} date, event_keys array<string>")
    if len(rows) <= MAX_BROADCAST_ROWS:
        days = F.broadcast(days)
    return frame.join(days, [key, ds], "left").withColumn("event_keys", F.coalesce("event_keys", none))


def events_table(spark: SparkSession, events: Sequence[Event]) -> DataFrame:
    """Configured events as a table for :func:`event_table_features`."""
    rows = [(e.symbol, e.name, e.day, e.lower, e.upper) for e in events]
    return spark.createDataFrame(rows, "symbol string, name string, day date, lower int, upper int")


def event_table_features(frame: DataFrame, events: DataFrame, key: str = "symbol", ds: str = "ds", bin_days: int = 32) -> DataFrame:
    """:func:`event_features` with events from a table (key, name, day, lower, upper) of any size.

    An interval join by bins: an event is copied to the bins of ``bin_days`` days that its window
    touches, a day lies in one bin, and days and events of a series meet by equality on the bin; the exact window decides
    after it. A series or a bin with many rows is a skewed equality join, which AQE splits. Long windows
    cost a row per bin, not per day. A window whose end lies before its start covers nothing; rows with
    a NULL series or day have no events.
    """
    offset = lambda c: F.date_add("day", F.col(c))
    binned = lambda day: F.floor(F.unix_date(day) / bin_days).cast("int")
    windows = events.select(key, "name", "day", offset("lower").alias("_from"), offset("upper").alias("_to")).distinct()
    windows = windows.filter(F.col("_from") <= F.col("_to"))
    windows = windows.withColumn("_bin", F.explode(F.sequence(binned("_from"), binned("_to"))))
    days = frame.select(key, ds).distinct().withColumn("_bin", binned(ds))
    covered = days.join(windows, [key, "_bin"]).filter(F.col(ds).between(F.col("_from"), F.col("_to")))
    name = F.concat("name", F.lit("_"), F.datediff(ds, "day").cast("string"))
    # Distinct names first: a day that many events cover holds each name once.
    found = covered.select(key, ds, name.alias("_key")).distinct()
    keys = found.groupBy(key, ds).agg(F.sort_array(F.collect_list("_key")).alias("event_keys"))
    none = F.array().cast("array<string>")
    return frame.join(keys, [key, ds], "left").withColumn("event_keys", F.coalesce("event_keys", none))
