"""Header, type and epoch normalisation of raw bars; schema projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import epoch_to_timestamp, with_calendar_parts
from tidemark.schemas import HEADER_ALIASES, OHLCV, require_columns


class HeaderClash(ValueError):
    """Two input headers mean the same column."""


def normalize_headers(df: DataFrame, aliases: Mapping[str, str] = HEADER_ALIASES) -> DataFrame:
    """Lower-case every header and apply the alias map; two headers for one column are an error."""
    target = [aliases.get(c.lower(), c.lower()) for c in df.columns]
    clash = sorted({c for c in target if target.count(c) > 1})
    if clash:
        raise HeaderClash(f"several headers map to {clash}: {df.columns}")
    return df.toDF(*target)


def _as_epoch(df: DataFrame, column: str):
    # Text epochs may carry a fraction ("1325412060.0"); doubles are exact far beyond them.
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("double").try_cast("bigint")
    return F.col(column).try_cast("bigint")


def normalize_bars(df: DataFrame, symbol: str | None = None, epoch_unit: str = "s") -> DataFrame:
    """Any raw bar frame to timestamp, datetime, OHLCV, symbol, year, month, other columns.

    ``timestamp`` is kept in seconds whatever the input unit; bad numbers become NULL.
    """
    df = normalize_headers(df)
    required = ["timestamp", *OHLCV] if symbol is not None else ["timestamp", *OHLCV, "symbol"]
    require_columns(df, required, "normalize_bars")
    stamp = epoch_to_timestamp(_as_epoch(df, "timestamp"), epoch_unit)
    extra = [c for c in df.columns if c not in {"timestamp", "datetime", "symbol", "year", "month", *OHLCV}]
    out = df.select(
        F.unix_seconds(stamp).alias("timestamp"),
        stamp.alias("datetime"),
        *[F.col(c).try_cast("double").alias(c) for c in OHLCV],
        (F.lit(symbol) if symbol is not None else F.col("symbol")).alias("symbol"),
        *extra,
    )
    return with_calendar_parts(out, "datetime")


def readable(bars: DataFrame) -> DataFrame:
    """Bars with a time stamp."""
    return bars.filter(F.col("timestamp").isNotNull())


def unreadable(bars: DataFrame) -> DataFrame:
    """Bars whose time stamp could not be read, for a reject table."""
    return bars.filter(F.col("timestamp").isNull())


DERIVED = ("datetime", "year", "month")


def without_derived(bars: DataFrame) -> DataFrame:
    """Bars without the columns that follow from ``timestamp``: less to shuffle."""
    return bars.drop(*DERIVED)


def with_derived(bars: DataFrame) -> DataFrame:
    """Add ``datetime``, ``year`` and ``month`` from the epoch-second ``timestamp``."""
    return with_calendar_parts(bars.withColumn("datetime", epoch_to_timestamp("timestamp", "s")), "datetime")


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns some source lacks are NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def model_input(daily: DataFrame, date: str = "date", value: str = "daily_close", key: str = "symbol") -> DataFrame:
    """The (ds, y, symbol) projection a forecast reads."""
    require_columns(daily, [date, value, key], "model_input")
    return daily.select(F.col(date).alias("ds"), F.col(value).alias("y"), key)
