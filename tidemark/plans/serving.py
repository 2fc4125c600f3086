"""The served daily series and what is derived from them, published together.

Three tables stand behind one manifest: ``daily_filled`` (gap-free days with averages), ``model_input``
(what forecasts read) and ``marks`` (first and last day of each series). A merge recomputes, per
series, from its first changed day on and writes the years it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import with_calendar_parts
from tidemark.operators.layers import change_starts, layer_only, merge_changes, splice
from tidemark.operators.normalize import model_input
from tidemark.operators.quality import keep_first
from tidemark.plans.layout import Layout
from tidemark.schemas import DAILY_OHLCV
from tidemark.sinks import materialize, publish, read_manifest, read_published

WINDOWS = (7, 30)
_SORT = {"daily_filled": ("symbol", "date"), "model_input": ("symbol", "ds"), "marks": ("symbol",)}
# Marks have one row per series and no year; they lie in one folder.
_NO_YEAR = 0


def read_daily(spark: SparkSession, layout: Layout, back: int = 0) -> DataFrame | None:
    """The gap-free daily series as last published."""
    return read_published(spark, layout.serving, "daily_filled", back=back)


def read_model_input(spark: SparkSession, layout: Layout, back: int = 0) -> DataFrame | None:
    found = read_published(spark, layout.serving, "model_input", back=back)
    return found if found is None else found.drop("year")


def read_marks(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """(symbol, first_date, last_date) of every series, without a scan of its days."""
    found = read_published(spark, layout.serving, "marks")
    return found if found is None else found.drop("year")


def _marks(daily: DataFrame, old: DataFrame | None = None) -> DataFrame:
    found = daily.groupBy("symbol").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    if old is not None:
        both = found.unionByName(old)
        found = both.groupBy("symbol").agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    return found.withColumn("year", F.lit(_NO_YEAR))


def _derived(old_marks: DataFrame | None = None) -> dict:
    return {
        "model_input": lambda daily: model_input(daily).withColumn("year", F.year("ds")),
        "marks": lambda daily: _marks(daily, old_marks),
    }


def publish_daily(spark: SparkSession, layout: Layout, filled: DataFrame, volume_policy: str = "zero") -> int:
    """Whole gap-free series as the new published state; their rule for volumes is kept with them."""
    daily = with_calendar_parts(filled, "date")
    settings = {"volume_policy": volume_policy}
    return publish(spark, layout.serving, {"daily_filled": daily, **_derived()}, settings=settings, sort_by=_SORT)


def merge_daily(spark: SparkSession, layout: Layout, layer: DataFrame, until: str | None = None, scale: int | None = None) -> int | None:
    """Put the days of ``layer`` that are not stored into the published series; returns the manifest's number.

    Stored days win. Holes are filled and, with ``until``, every series reaches that day, by the rule for
    volumes the series were published with. Reads the years from the first change (less the reach of the averages)
    on and writes the years in which days change; ``None`` when there is nothing to do.
    """
    manifest = read_manifest(spark, layout.serving)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published below {layout.serving}")

    def stored(table: str, first: int | None = None, last: int | None = None, only: list[int] | None = None) -> DataFrame:
        held = map(int, manifest["tables"][table]["years"])
        years = [y for y in held if (first is None or y >= first) and (last is None or y <= last) and (only is None or y in only)]
        return read_published(spark, layout.serving, table, years, manifest=manifest)

    days = layer.withColumn("date", F.col("date").cast("date"))
    known = [c for c in DAILY_OHLCV if c in days.columns]
    more = [c for c in ("cnt",) if c in days.columns]
    days = keep_first(days.select("symbol", "date", *known, *more), ["symbol", "date"], [*known, *more])
    span = days.agg(F.year(F.min("date")), F.year(F.max("date"))).first()
    fresh = days.limit(0) if span[0] is None else materialize(layer_only(days, stored("daily_filled", *span)), "fresh-days")

    marks = stored("marks").drop("year")
    starts = change_starts(fresh, marks, stored("daily_filled", last=span[1])).select("symbol", "start")
    if until is not None:
        short = marks.filter(F.col("last_date") < F.lit(until).cast("date")).select("symbol", F.date_add("last_date", 1).alias("start"))
        starts = starts.unionByName(short).groupBy("symbol").agg(F.min("start").alias("start"))
    starts = materialize(starts, "change-starts")
    first = starts.agg(F.year(F.date_sub(F.min("start"), max(WINDOWS) - 1))).first()[0]
    if first is None:
        return None

    end = None if until is None else F.lit(until).cast("date")
    parts = ("year", "month")
    held = stored("daily_filled", first=first).drop(*parts)
    policy = manifest["settings"]["volume_policy"]
    changed = materialize(merge_changes(held, fresh, starts, end, policy, WINDOWS, scale), "changed-days")
    # As many as there are years.
    touched = [r[0] for r in changed.select(F.year("date")).distinct().collect()]
    table = splice(stored("daily_filled", only=touched).drop(*parts), changed, starts)
    return publish(
        spark,
        layout.serving,
        {"daily_filled": with_calendar_parts(table, "date"), **_derived(marks)},
        years={"daily_filled": touched, "model_input": touched, "marks": [_NO_YEAR]},
        sort_by=_SORT,
        after=manifest["number"],
    )
