"""Incremental loads and the merge of batch and speed layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.calendar import fill_calendar, moving_averages
from tidemark.operators.quality import high_water_mark, keep_first
from tidemark.schemas import DAILY_OHLCV, require_columns


def incremental_slice(
    fresh: DataFrame, loaded: DataFrame | None, as_of: Column, key: str = "symbol", date: str = "date", marks: DataFrame | None = None
) -> DataFrame:
    """Rows after the last loaded date of their own series, up to ``as_of``; new series entire.

    ``marks`` (key, last_date) saves the scan of ``loaded``. The mark table has one row per series. Its size is not known in advance, so no broadcast
    is forced: AQE broadcasts it when it measures small and splits hot series otherwise.
    """
    marks = high_water_mark(loaded, key, date) if marks is None else marks.select(key, "last_date")
    joined = fresh.filter(F.col(date) <= as_of).join(marks, key, "left")
    return joined.filter(F.col("last_date").isNull() | (F.col(date) > F.col("last_date"))).drop("last_date")


def merge_layers(
    layers: Sequence[DataFrame],
    columns: Sequence[str] = DAILY_OHLCV,
    key: str = "symbol",
    date: str = "date",
    windows: Sequence[int] = (7, 30),
    scale: int | None = None,
) -> DataFrame:
    """Union of daily layers, earlier layers winning per (key, date); averages recomputed.

    The priority is an explicit rank, followed by the values themselves, so the outcome is
    the same under any partitioning. Stored averages are never merged.
    """
    ranked = None
    for rank, layer in enumerate(layers):
        require_columns(layer, [key, date], f"merge_layers[{rank}]")
        known = [c for c in columns if c in layer.columns]
        part = layer.select(key, F.col(date).cast("date").alias(date), *known, F.lit(rank).alias("_source_rank"))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    present = [c for c in columns if c in ranked.columns]
    merged = keep_first(ranked, [key, date], ["_source_rank", *present]).drop("_source_rank")
    return moving_averages(merged, windows=windows, key=key, date=date, scale=scale)


def fill_forward(merged: DataFrame, until: Column | None = None, volume_policy: str = "carry", key: str = "symbol", date: str = "date") -> DataFrame:
    """Merged daily rows without holes, whichever layers they came from.

    Days between the stored end and the first fresh day, and days up to ``until`` of series
    that got no fresh row, carry the last row; averages count days again, not rows.
    """
    bare = merged.select(key, date, *[c for c in DAILY_OHLCV if c in merged.columns])
    if until is not None:
        # Stored days behind ``until`` stay.
        last = F.greatest(until, F.max(date).over(Window.partitionBy(key)))
        bare = bare.withColumn("_until", last)
        filled = fill_calendar(bare, volume_policy, key=key, until=F.col("_until"))
        return moving_averages(filled.drop("_until", "is_filled"), key=key, date=date)
    return moving_averages(fill_calendar(bare, volume_policy, key=key).drop("is_filled"), key=key, date=date)


def change_starts(
    fresh: DataFrame, marks: DataFrame, older: DataFrame, key: str = "symbol", date: str = "date"
) -> DataFrame:
    """(key, start, known): the first day of each series that ``fresh`` rows change, and the stored day before it.

    ``fresh`` rows are not stored yet. A series changes from the day behind the last stored day
    before its first fresh one: holes between the two are filled too. ``marks`` has the last
    stored day per series; only series whose first fresh day lies before that are looked up in ``older``
    stored rows. ``known`` is NULL for a series without an earlier day.
    """
    first = fresh.groupBy(key).agg(F.min(date).alias("_first")).join(marks.select(key, F.col("last_date").alias("_last")), key, "left")
    inside = first.filter(F.col("_last") >= F.col("_first")).select(key, "_first")
    before = older.select(key, date).join(inside, key).filter(F.col(date) < F.col("_first")).groupBy(key).agg(F.max(date).alias("_before"))
    found = first.join(before, key, "left")
    known = F.when(F.col("_last") < F.col("_first"), F.col("_last")).otherwise(F.col("_before"))
    return found.select(key, F.coalesce(F.date_add(known, 1), F.col("_first")).alias("start"), known.alias("known"))


def merge_changes(
    stored: DataFrame,
    fresh: DataFrame,
    starts: DataFrame,
    until: Column | None = None,
    volume_policy: str = "zero",
    windows: Sequence[int] = (7, 30),
    scale: int | None = None,
    key: str = "symbol",
    date: str = "date",
) -> DataFrame:
    """The rows from ``start`` on of the series in ``starts``, as a full recomputation of the table would give them.

    ``stored`` is gap-free per series and wins where both have a day; ``fresh`` rows are others.
    Averages of n days need the n - 1 days before ``start``, so only those and later stored rows
    take part. ``is_filled`` marks days no layer has; other columns of ``stored`` are kept.
    """
    reach = max(windows) - 1
    bounds = starts.withColumn("_from", F.date_sub("start", reach))
    prices = [c for c in DAILY_OHLCV if c in stored.columns]
    averages = [f"ma{n}" for n in windows]
    more = [c for c in stored.columns if c not in {key, date, "is_filled", *prices, *averages}]
    held = stored.join(bounds.select(key, "_from"), key).filter(F.col(date) >= F.col("_from")).drop("_from", *averages)
    had = F.coalesce(F.col("is_filled"), F.lit(False)) if "is_filled" in stored.columns else F.lit(False)
    held = held.withColumn("_filled", had).drop("is_filled")
    given = fresh.select(key, F.col(date).cast("date").alias(date), *[c for c in (*prices, *more) if c in fresh.columns])
    both = held.unionByName(given.withColumn("_filled", F.lit(False)), allowMissingColumns=True)
    if until is not None:
        last = F.greatest(until, F.max(date).over(Window.partitionBy(key)))
        both = both.withColumn("_until", last)
    dense = fill_calendar(both, volume_policy, key=key, until=None if until is None else F.col("_until"))
    dense = dense.withColumn("is_filled", F.col("is_filled") | F.coalesce("_filled", F.lit(False))).drop("_filled", "_until")
    averaged = moving_averages(dense, windows=windows, key=key, date=date, scale=scale)
    changed = averaged.join(starts.select(key, "start"), key).filter(F.col(date) >= F.col("start")).drop("start")
    return changed.select(*[c for c in stored.columns if c in changed.columns])


def splice(stored: DataFrame, changed: DataFrame, starts: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Stored rows with the rows from each series' ``start`` on replaced by ``changed``."""
    kept = stored.join(starts.select(key, "start"), key, "left").filter(F.col("start").isNull() | (F.col(date) < F.col("start")))
    return kept.drop("start").unionByName(changed, allowMissingColumns=True)


def backfill_ranges(loaded: DataFrame, as_of: Column, key: str = "symbol", date: str = "date") -> DataFrame:
    """What is still to be fetched: (key, first_day, last_day, days) per series that ends before ``as_of``."""
    marks = high_water_mark(loaded, key, date)
    ranges = marks.select(key, F.date_add("last_date", 1).alias("first_day"), as_of.alias("last_day"))
    return ranges.withColumn("days", F.datediff("last_day", "first_day") + 1).filter("days > 0")


def layer_overlap(first: DataFrame, second: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """(key, date) pairs both layers hold."""
    return first.select(key, date).intersect(second.select(key, date))


def layer_only(first: DataFrame, second: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Rows of ``first`` whose (key, date) the other layer lacks."""
    return first.join(second.select(key, date), [key, date], "left_anti")
