"""Duplicates, counts, gaps, coverage and audits.

Keys may be badly skewed, so nothing here sorts or windows a whole series of raw rows:
aggregates combine on the map side, and ordered work happens inside bounded time segments.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import day_of
from tidemark.functions.times import SECONDS_PER_DAY
from tidemark.schemas import require_columns

# A result of at most this many rows, by construction, may be broadcast.
MAX_BROADCAST_ROWS = 10_000


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the stated order.

    The rank filter becomes a group limit that runs before the shuffle, so a key repeated in
    a third of the rows sends one row per map task. ``order_by`` should be total on rows that
    differ; then the result does not depend on partitioning.
    """
    require_columns(df, keys, "keep_first")
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def per_day_counts(df: DataFrame, key: str = "symbol", ts: str = "datetime", tz: str | None = None) -> DataFrame:
    return df.groupBy(key, day_of(ts, tz).alias("date")).agg(F.count(F.lit(1)).alias("count"))


def day_bounds(df: DataFrame, key: str = "symbol", ts: str = "timestamp", day: Column | None = None) -> DataFrame:
    """First and last time stamp of each (key, day)."""
    day = F.to_date(ts) if day is None else day
    return df.groupBy(key, day.alias("date")).agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def time_gaps(
    df: DataFrame, key: str = "symbol", ts: str = "timestamp", segment_seconds: int = SECONDS_PER_DAY, unique: bool = False
) -> DataFrame:
    """Every pair of neighbouring distinct time stamps per key: (key, ts, prev_ts, gap).

    Neighbours inside a time segment come from a window over (key, segment); the first
    stamp of a segment is paired with the last stamp of the previous non-empty one, from a
    table with a single row per (key, segment). A segment holds at most ``segment_seconds``
    distinct stamps of the epoch-second column, however many rows the key has.
    ``unique`` says that (key, ts) has no repeats and saves the shuffle that removes them.
    """
    require_columns(df, [key, ts], "time_gaps")
    segment = F.floor(F.col(ts) / F.lit(segment_seconds)).cast("bigint").alias("_segment")
    stamps = df.filter(F.col(ts).isNotNull()).select(key, segment, ts)
    if not unique:
        stamps = stamps.distinct()  # repeated stamps collapse on the map side
    # Both branches below start from one exchange by (key, segment), which Spark reuses.
    stamps = stamps.repartition(key, "_segment")
    inside = stamps.withColumn("prev_ts", F.lag(ts).over(Window.partitionBy(key, "_segment").orderBy(ts)))
    bounds = (
        stamps.groupBy(key, "_segment")
        .agg(F.min(ts).alias(ts), F.max(ts).alias("_last"))
        .withColumn("prev_ts", F.lag("_last").over(Window.partitionBy(key).orderBy("_segment")))
    )
    pairs = inside.select(key, ts, "prev_ts").unionByName(bounds.select(key, ts, "prev_ts"))
    return pairs.filter("prev_ts is not null").withColumn("gap", F.col(ts) - F.col("prev_ts"))


def large_gaps(
    bars: DataFrame,
    key: str = "symbol",
    ts: str = "timestamp",
    threshold: int = 60,
    top: int = 100,
    order_by: Sequence[str] = (),
    segment_seconds: int = SECONDS_PER_DAY,
    unique: bool = False,
) -> DataFrame:
    """The ``top`` longest gaps above ``threshold``, with the bar that ends each gap.

    Only (key, ts) is shuffled to find the gaps; the other bar columns are fetched
    afterwards for the few winning stamps.
    """
    gaps = time_gaps(bars, key, ts, segment_seconds, unique).filter(F.col("gap") > threshold)
    winners = gaps.orderBy(F.desc("gap"), key, ts).limit(top)
    if top <= MAX_BROADCAST_ROWS:
        winners = F.broadcast(winners)
    found = winners.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), "prev_ts", "gap")
    # A NULL series has gaps like any other.
    ending = bars.join(found, F.col(key).eqNullSafe(F.col("_key")) & (F.col(ts) == F.col("_ts"))).drop("_key", "_ts")
    return keep_first(ending, [key, ts], order_by or [c for c in bars.columns if c not in (key, ts)]).select(
        key, ts, *[c for c in bars.columns if c not in (key, ts)], "prev_ts", "gap"
    )


def coverage(df: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Rows and first/last date per series."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def high_water_mark(df: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    """Last loaded date per series."""
    return df.groupBy(key).agg(F.max(date).alias("last_date"))


def footer_marks(spark: SparkSession, path: str, value: str, partition_by: Sequence[str]) -> DataFrame:
    """(partition columns, first, last, rows) of a partitioned Parquet table, from file footers alone.

    Parquet keeps count, minimum and maximum of each column chunk; Spark's reader answers the aggregate
    from these where the groups are the partition folders and nothing is filtered. No row is read: the cost follows the
    number of files. The value must be a number, a date or a boolean; all files must have the same columns
    in the same order, as one writer leaves them. Partition columns come as text.
    """
    # The settings choose the reader that can do so, in a session of its own.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # The footers' own order of columns, with partition columns as written.
    held = [f for f in own.read.parquet(path).schema.fields if f.name not in partition_by]
    table = own.read.schema(T.StructType([*held, *[T.StructField(c, T.StringType()) for c in partition_by]])).parquet(path)
    return table.groupBy(*partition_by).agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("rows"))


def series_marks(
    spark: SparkSession, path: str, key: str = "symbol", value: str = "timestamp", partition_by: Sequence[str] = ("symbol", "year", "month")
) -> DataFrame:
    """First and last value and rows per series of a bar table, without reading its rows."""
    parts = footer_marks(spark, path, value, partition_by)
    return parts.groupBy(key).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))


def stage_audit(bars: DataFrame, key: str, ts: str, values: Sequence[str]) -> DataFrame:
    """Row accounting of the cleaning stage in one job: raw, with a null value, repeated, unique."""
    has_null = reduce(or_, [F.col(c).isNull() for c in values]).cast("int")
    per_stamp = bars.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"), F.sum(has_null).alias("_null"))
    return per_stamp.groupBy(key).agg(
        F.sum("_n").alias("rows_in"),
        F.sum("_null").alias("rows_with_null"),
        F.sum(F.col("_n") - 1).alias("rows_repeated"),
        F.count(F.lit(1)).alias("rows_unique"),
    )


def observed(df: DataFrame, name: str, values: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """Count rows (and nulls per value column) while another action runs; no extra job."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in values]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), seen


def dataset_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, rows, nulls and range of columns of any type, one output row per column.

    Numbers have min, max, mean and deviation; other types have their range as text in
    ``first_value`` and ``last_value`` (dates and times by time, text by code point). What a type
    lacks is NULL.
    One pass over the table computes all columns side by side; the unpivot works on its single
    result row.
    """
    require_columns(df, columns, "dataset_profile")
    types = dict(df.dtypes)

    def numeric(c: str) -> bool:
        return isinstance(df.schema[c].dataType, T.NumericType)

    def number(c: str) -> Column:
        return F.col(c).cast("double") if numeric(c) else F.lit(None).cast("double")

    def text(c: str) -> Column:
        return F.lit(None).cast("string") if numeric(c) else F.col(c).cast("string")

    stats = {
        "row_count": lambda c: F.count(F.lit(1)),
        "null_count": lambda c: F.count_if(F.col(c).isNull()),
        "min_value": lambda c: F.min(number(c)),
        "max_value": lambda c: F.max(number(c)),
        "mean_value": lambda c: F.avg(number(c)),
        "std_value": lambda c: F.stddev_samp(number(c)),
        "first_value": lambda c: F.min(text(c)),
        "last_value": lambda c: F.max(text(c)),
    }
    wide = df.agg(*[fn(c).alias(f"{c}|{name}") for c in columns for name, fn in stats.items()])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            *[F.col(f"`{c}|{name}`").alias(name) for name in stats],
        )
        for c in columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
