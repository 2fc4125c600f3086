"""Quantiles and distinct counts of a partitioned table from a table of sketches.

Each part of the table (a year, a day, a file set) has one row per column: counts, a quantile sketch
(KLL) of its numbers and a distinct-count sketch (HLL). Sketches of parts merge, so a profile of the
whole table reads the sketch table alone, and when some parts of the data change, only theirs are made
again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import require_columns
from tidemark.sinks.tables import write_partitioned
from tidemark.sources.storage import exists

KLL_K = 400  # rank error about 0.7 %
HLL_LOG_K = 12  # relative error about 1.6 %
# What the tests allow: about three deviations of each.
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.05
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)
PART = "part"


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def sketch_parts(df: DataFrame, columns: Sequence[str], part: str | Column) -> DataFrame:
    """(part, column, rows, nulls, quantiles, distinct): one row per part and column, from one pass.

    Sketches are combined on the map side, so a part with a third of the rows is no hot task.
    """
    require_columns(df, columns, "sketch_parts")
    stats = []
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if _is_number(df, c) else F.lit(None).cast("double")
        stats += [
            F.count(c).alias(f"n{i}"),
            F.kll_sketch_agg_double(F.when(~F.isnan(number), number), KLL_K).alias(f"q{i}") if _is_number(df, c) else F.lit(None).cast("binary").alias(f"q{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), HLL_LOG_K).alias(f"d{i}"),
        ]
    key = F.col(part) if isinstance(part, str) else part
    wide = df.groupBy(key.cast("string").alias(PART)).agg(F.count(F.lit(1)).alias("rows"), *stats)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.when(F.col(f"n{i}") > 0, F.col(f"q{i}")).alias("quantiles"),
            F.col(f"d{i}").alias("distinct"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(PART, F.inline(F.array(*rows)))


def store_sketches(df: DataFrame, path: str, columns: Sequence[str], part: str | Column) -> None:
    """Sketch the parts present in ``df`` and store them; the sketches of other parts stay.

    The caller passes the rows of new and changed parts only, each part whole.
    """
    made = sketch_parts(df, columns, part)
    write_partitioned(made, path, (PART,), only_touched=exists(df.sparkSession, path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    kind = f"column string, rows long, nulls long, quantiles binary, `distinct` binary, {PART} string"
    return spark.read.schema(kind).parquet(path)


def sketch_profile(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column, rows, nulls, distinct, q1, q2, ...) of the whole table, from the sketches of its parts.

    Quantiles are NULL for columns that hold no numbers.
    """
    merged = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.count("quantiles").alias("_some"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("_merged"),
    )
    value = lambda p: F.when(F.col("_some") > 0, F.kll_sketch_get_quantile_double("_merged", F.lit(p)))
    return merged.select("column", "rows", "nulls", "distinct", *[value(p).alias(f"q{i}") for i, p in enumerate(quantiles, start=1)])
