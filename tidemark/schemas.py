"""Schemas shared by sources, operators and tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

OHLC = ("open", "high", "low", "close")
OHLCV = (*OHLC, "volume")
DAILY_OHLC = ("daily_open", "daily_high", "daily_low", "daily_close")
DAILY_OHLCV = (*DAILY_OHLC, "daily_volume")

# Header spellings accepted for a bar column (compared in lower case).
HEADER_ALIASES = {
    "unix": "timestamp",
    "time": "timestamp",
    "ts": "timestamp",
    "open_": "open",
    "volume_btc": "volume",
    "volume_eth": "volume",
}

# The fields of one price message, as the broker carries them.
MESSAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("quote_volume", T.DoubleType()),
        T.StructField("number_trades", T.IntegerType()),
        T.StructField("price_change", T.DoubleType()),
        T.StructField("price_change_percent", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Message field -> (24-hour ticker field, type after conversion).
TICKER_FIELDS = {
    "symbol": ("symbol", "string"),
    "event_time": ("closeTime", "bigint"),
    "price": ("lastPrice", "double"),
    "open": ("openPrice", "double"),
    "high": ("highPrice", "double"),
    "low": ("lowPrice", "double"),
    "volume": ("volume", "double"),
    "quote_volume": ("quoteVolume", "double"),
    "number_trades": ("count", "int"),
    "price_change": ("priceChange", "double"),
    "price_change_percent": ("priceChangePercent", "double"),
}

# Positions inside one 12-element kline array.
KLINE_POSITIONS = {
    "open_time": (0, "bigint"),
    "open": (1, "double"),
    "high": (2, "double"),
    "low": (3, "double"),
    "close": (4, "double"),
    "volume": (5, "double"),
    "close_time": (6, "bigint"),
    "quote_volume": (7, "double"),
    "trades": (8, "bigint"),
    "taker_buy_base": (9, "double"),
    "taker_buy_quote": (10, "double"),
}


class MissingColumns(ValueError):
    """An operator was given a frame without the columns it needs."""


def require_columns(df: DataFrame, columns: Iterable[str], who: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or fail on the driver before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{who}: missing columns {missing}; present {df.columns}")
    return df
