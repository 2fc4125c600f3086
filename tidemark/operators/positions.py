"""Global order with positions, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sinks.tables import materialize

_ROW_BITS = 33  # Spark's row ids: the part above them, the row within the part below


def with_positions(df: DataFrame, order_by: Sequence[str | Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """``df`` with each row's place (1, 2, ...) in the order of all rows.

    Rows are dealt to ranges of the order and sorted there, which gives each its place in its range;
    the ranges' sizes, one row per range, are summed up to where each begins. No window runs over
    rows. ``order_by`` should tell all rows apart: rows it doesn't tell apart lie in one range, in any
    order. The ranges are stored, because a second pass over the input could deal rows otherwise.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    row = ranged.withColumn("_row", F.monotonically_increasing_id())
    stored = materialize(row, "ranges")
    part = F.shiftright("_row", _ROW_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # As many rows as there are ranges.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = stored.withColumn("_part", part).join(starts, "_part")
    within = F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.withColumn(name, F.col("_start") + within + 1).drop("_part", "_row", "_start")


def rows_between(positioned: DataFrame, first: int, last: int, name: str = "position") -> DataFrame:
    """Rows at positions ``first`` to ``last``: a page of the global order."""
    return positioned.filter(F.col(name).between(first, last))
