"""Forward fill of raw bars that survives a series holding most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import SECONDS_PER_DAY
from tidemark.operators.quality import keep_first
from tidemark.schemas import OHLC, OHLCV, require_columns


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "symbol",
    ts: str = "timestamp",
    segment: Column | None = None,
) -> DataFrame:
    """Replace NULL by the last earlier value of the series; (key, ts) must be unique.

    Two levels instead of one window per series. The last known values of each
    (key, segment), one row each and combined on the map side, are rolled forward over the
    segments; every segment then starts with a carry row holding what came before it, and
    one window per (key, segment) fills the rest. There is no join, so rows with a NULL key
    form a series of their own, as in a plain window. The default segment is the UTC day of
    an epoch-second column: at most 86,400 rows, because stamps are unique.
    """
    require_columns(df, [key, ts, *columns], "forward_fill")
    segment = F.floor(F.col(ts) / F.lit(SECONDS_PER_DAY)).cast("bigint") if segment is None else segment
    rows = df.withColumn("_segment", segment)

    last_known = rows.groupBy(key, "_segment").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in columns]
    )
    before = Window.partitionBy(key).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_known.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in columns})

    both = rows.withColumn("_is_row", F.lit(True)).unionByName(
        carry.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
    )
    inside = Window.partitionBy(key, "_segment").orderBy("_is_row", ts).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return filled.filter("_is_row").select(*df.columns)


def fill_bars(bars: DataFrame, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Prices and volume carried forward; a volume with no earlier value is zero."""
    return forward_fill(bars, OHLCV, key, ts).withColumn("volume", F.coalesce("volume", F.lit(0.0)))


def clean_bars(
    bars: DataFrame, order_by: Sequence[str | Column] = (), key: str = "symbol", ts: str = "timestamp"
) -> DataFrame:
    """Deduplicate, forward fill, then drop rows whose prices never had a value.

    Duplicates go first, so that which copy survives is decided on the data as delivered.
    """
    tie = [*order_by, *[c for c in bars.columns if c not in (key, ts)]]  # total: no row survives by chance
    return complete_bars(keep_first(bars, [key, ts], tie), key, ts)


def complete_bars(bars: DataFrame, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Fill bars that are unique per (key, ts) and drop those whose prices never had a value."""
    return fill_bars(bars, key, ts).dropna(subset=[*OHLC, "volume"])
