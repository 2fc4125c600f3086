"""The batch chain: raw files to bars, daily tables, gap-free series and reports.

Each step reads stored tables and writes stored tables, so a step that several outputs
depend on is computed once and a lost executor only repeats work inside its step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import day_of, with_calendar_parts
from tidemark.operators import calendar, quality, reports
from tidemark.operators.fill import complete_bars
from tidemark.operators.layers import incremental_slice
from tidemark.operators.normalize import DERIVED, normalize_bars, readable, union_sources, unreadable, with_derived, without_derived
from tidemark.operators.resample import daily_bars
from tidemark.plans.layout import Layout
from tidemark.plans.serving import merge_daily, publish_daily, read_daily, read_marks
from tidemark.schemas import OHLCV
from tidemark.plans.speed import read_speed_layer
from tidemark.sinks import DAILY_LAYOUT, DAILY_ORDER, read_partitioned, write_csv, write_partitioned
from tidemark.sources import kline_rejects, klines_to_bars, read_bars, read_first_available, read_kline_pages


def convert(spark: SparkSession, layout: Layout, sources: Mapping[str, str], epoch_unit: str = "s") -> None:
    """Raw CSV of each series to one Parquet bar table by symbol, year and month."""
    frames = [read_bars(spark, path, symbol, epoch_unit) for symbol, path in sources.items()]
    _store_bars(union_sources(frames), layout)


def convert_folder(spark: SparkSession, layout: Layout, path: str, pattern: str = r"([^/]+?)\.csv[^/]*$", epoch_unit: str = "s") -> None:
    """:func:`convert` for a folder of many series: the name comes from the file's, one scan per header family."""
    symbol = F.regexp_extract("_metadata.file_path", pattern, 1)
    _store_bars(read_bars(spark, path, symbol, epoch_unit), layout)


def _store_bars(bars: DataFrame, layout: Layout) -> None:
    """Bars by symbol, year and month; rows without a readable stamp to a reject table."""
    unreadable(bars).drop(*DERIVED).write.mode("overwrite").parquet(layout.path("bar_rejects"))
    write_partitioned(readable(bars), layout.bars)


def clean(spark: SparkSession, layout: Layout, order_by: Sequence[str] = ()) -> dict[str, int]:
    """Unique, forward-filled, null-free bars; returns the row counts before and after."""
    stored = read_partitioned(spark, layout.bars)
    raw = without_derived(normalize_bars(stored))
    rest = [c for c in raw.columns if c not in ("symbol", "timestamp", *OHLCV)]
    unique = quality.keep_first(readable(raw), ["symbol", "timestamp"], [*order_by, *OHLCV, *rest])
    cleaned, seen = quality.observed(complete_bars(unique), "bars_clean")
    write_partitioned(with_derived(cleaned), layout.bars_clean)
    return {"rows_in": stored.count(), "rows_clean": seen.get["rows"]}


def daily(spark: SparkSession, layout: Layout, tz: str | None = None) -> None:
    """Daily bars with the per-day counts and the largest gaps of the minute bars."""
    bars = read_partitioned(spark, layout.bars_clean)
    write_csv(quality.per_day_counts(bars, tz=tz), layout.report("per_day_counts"))
    write_csv(quality.large_gaps(bars, unique=True), layout.report("large_gaps"), ordered=True)
    # Stamps are unique after cleaning, so the plain time order needs no tie-break.
    table = with_calendar_parts(daily_bars(bars, day_of("datetime", tz), ["timestamp"]), "date")
    write_partitioned(table, layout.daily_raw, DAILY_LAYOUT, sort_by=DAILY_ORDER)
    write_csv(spark.read.parquet(layout.daily_raw), layout.report("daily_raw"))


def fill(spark: SparkSession, layout: Layout, volume_policy: str = "zero") -> None:
    """Gap-free daily series with averages, the missing days, and the four reports."""
    raw = spark.read.parquet(layout.daily_raw).drop("year", "month")
    write_csv(calendar.missing_days(raw), layout.report("missing_days"))
    publish_daily(spark, layout, calendar.moving_averages(calendar.fill_calendar(raw, volume_policy)), volume_policy)
    stored = read_daily(spark, layout)
    stored.createOrReplaceTempView("daily_series")
    tables = {
        "top_price_change_days": reports.top_price_change_days(stored),
        "top_volume_days": reports.top_volume_days(stored),
        "avg_volume_per_month": reports.avg_volume_per_month(stored).orderBy("month", "symbol"),
        "avg_return_per_year": reports.avg_return_per_year(stored).orderBy("year", "symbol"),
    }
    for name, table in tables.items():
        write_csv(table, layout.report(name), ordered=True)


def backfill(
    spark: SparkSession,
    layout: Layout,
    pages: str,
    as_of: str,
    symbol_pattern: str = r"([A-Z0-9]+)[^/]*$",
    symbol: Column | None = None,
    volume_policy: str = "zero",
) -> None:
    """Landed kline pages after each series' last stored day, merged behind the stored days.

    The stored table wins where both have a day. The symbol comes from the file name, or is an
    expression over ``source_file``. Holes between stored and fresh days are filled, and every
    series reaches ``as_of``. ``volume_policy`` is for a first publication; later ones keep theirs. Last stored days come from the published marks, and only the years
    from there on are written again.
    """
    name = F.regexp_extract("source_file", symbol_pattern, 1) if symbol is None else symbol
    landed = read_kline_pages(spark, pages).withColumn("symbol", name)
    kline_rejects(landed).write.mode("overwrite").parquet(layout.path("kline_rejects"))
    bars = quality.keep_first(klines_to_bars(landed), ["symbol", "timestamp"], OHLCV)
    fresh = daily_bars(bars.withColumn("date", F.to_date("datetime")), F.col("date"), ["timestamp"])
    marks, end = read_marks(spark, layout), F.lit(as_of).cast("date")
    if marks is None:
        days = fresh.filter(F.col("date") <= end)
        publish_daily(spark, layout, calendar.moving_averages(calendar.fill_calendar(days, volume_policy, until=end)), volume_policy)
    else:
        merge_daily(spark, layout, incremental_slice(fresh, None, end, marks=marks), until=as_of)


def merge(spark: SparkSession, layout: Layout, speed_paths: Sequence[str] | None = None) -> bool:
    """Batch and speed layer to the served tables; without a speed layer they stay as they are."""
    if read_daily(spark, layout) is None:
        raise FileNotFoundError(f"nothing is published below {layout.serving}")
    speed = read_first_available(spark, speed_paths) if speed_paths else read_speed_layer(spark, layout)
    if speed is not None:
        merge_daily(spark, layout, speed)
    return speed is not None
