"""JSON messages and ticker snapshots; the same code serves batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import day_of, epoch_to_timestamp
from tidemark.schemas import MESSAGE, TICKER_FIELDS, require_columns


def ticker_to_messages(
    df: DataFrame, value: str = "value", seen_at: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw 24-hour ticker JSON to the message columns, text numbers converted."""
    require_columns(df, [value, *keep], "ticker_to_messages")
    raw = ", ".join(f"`{source}` string" for source, _ in TICKER_FIELDS.values())
    parsed = df.withColumn("_t", F.from_json(F.col(value).cast("string"), raw))
    fields = [F.col("_t")[source].try_cast(dtype).alias(name) for name, (source, dtype) in TICKER_FIELDS.items()]
    stamp = F.date_format(F.col(seen_at), "yyyy-MM-dd'T'HH:mm:ss") if seen_at else F.lit(None).cast("string")
    return parsed.select(*keep, *fields, stamp.alias("timestamp"))


def parse_messages(
    df: DataFrame, value: str = "value", keep: Sequence[str] = (), tz: str | None = None
) -> DataFrame:
    """Broker rows to typed columns with event time, date and hour.

    Rows that are not JSON or lack the symbol or event time are marked by ``is_valid`` =
    false instead of being dropped, so a caller can route them (:func:`rejects`).
    """
    require_columns(df, [value, *keep], "parse_messages")
    parsed = df.select(*keep, F.from_json(F.col(value).cast("string"), MESSAGE).alias("data"), F.col(value).alias("_raw"))
    flat = parsed.select(*keep, "data.*", "_raw")
    event_ts = epoch_to_timestamp("event_time", "ms")
    local = F.from_utc_timestamp(event_ts, tz) if tz else event_ts
    return flat.select(
        *[c for c in flat.columns if c != "_raw"],
        event_ts.alias("event_timestamp"),
        day_of(event_ts, tz).alias("date"),
        F.hour(local).alias("hour"),
        (F.col("symbol").isNotNull() & F.col("event_time").isNotNull()).alias("is_valid"),
        F.col("_raw").cast("string").alias("raw"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("is_valid", "raw")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_valid")).select("raw")
