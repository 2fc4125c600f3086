"""Landed kline pages: one JSON array of 12-element arrays per text line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_to_timestamp
from tidemark.schemas import KLINE_POSITIONS, OHLCV, require_columns


def read_kline_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines as (page, source_file); the symbol is taken by the caller from the file name."""
    return spark.read.text(path).select(
        F.col("value").alias("page"), F.col("_metadata.file_path").alias("source_file")
    )


def explode_klines(pages: DataFrame, page: str = "page", keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """All positions of each kline as typed columns; malformed pages and values become NULL."""
    require_columns(pages, [page, *keep], "explode_klines")
    rows = pages.select(*keep, F.explode(F.from_json(page, "array<array<string>>")).alias("_k"))
    fields = [
        F.get("_k", F.lit(position)).try_cast(dtype).alias(name)
        for name, (position, dtype) in KLINE_POSITIONS.items()
    ]
    return rows.select(*keep, *fields)


def kline_rejects(pages: DataFrame, page: str = "page", keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """What :func:`klines_to_bars` leaves out: (keep, raw, reason) per unreadable page or row.

    A page that is no array of arrays is one reject; a row without a readable open time is one. NULL
    pages count as pages, empty pages have no rows and no rejects.
    """
    require_columns(pages, [page, *keep], "kline_rejects")
    parsed = pages.withColumn("_rows", F.from_json(page, "array<array<string>>"))
    position, dtype = KLINE_POSITIONS["open_time"]
    bad_pages = parsed.filter(F.col("_rows").isNull()).select(*keep, F.col(page).alias("raw"), F.lit("page").alias("reason"))
    rows = parsed.select(*keep, F.explode("_rows").alias("_k"))
    bad = F.get("_k", F.lit(position)).try_cast(dtype).isNull()
    return bad_pages.unionByName(rows.filter(bad).select(*keep, F.to_json("_k").alias("raw"), F.lit("row").alias("reason")))


def klines_to_bars(pages: DataFrame, page: str = "page", keep: Sequence[str] = ("symbol",)) -> DataFrame:
    """Kline pages to bars: open time in ms becomes ``timestamp`` in s and ``datetime``."""
    parsed = explode_klines(pages, page, keep).filter(F.col("open_time").isNotNull())
    return parsed.select(
        *keep,
        F.floor(F.col("open_time") / 1000).cast("bigint").alias("timestamp"),
        epoch_to_timestamp("open_time", "ms").alias("datetime"),
        *OHLCV,
    )
