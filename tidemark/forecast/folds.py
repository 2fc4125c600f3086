"""Rolling-origin cross-validation folds inside the training range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import require_columns


def with_folds(
    frame: DataFrame, horizon: int = 30, period: int = 15, reach: int = 60, key: str = "symbol", ds: str = "ds"
) -> DataFrame:
    """Training rows once per fold, as (fold, cutoff, is_train).

    With T the last training day, cutoffs run from T - ``reach`` to T - ``horizon`` every
    ``period`` days. A fold trains up to its cutoff and is tested on the next ``horizon``
    days; later rows are not part of it. The fold list is an array per row, not a range join.
    """
    require_columns(frame, [key, ds, "is_train"], "with_folds")
    history = frame.filter("is_train").drop("is_train")
    last = F.max(ds).over(Window.partitionBy(key))
    cutoffs = F.sequence(F.date_sub(last, reach), F.date_sub(last, horizon), F.expr(f"interval {period} days"))
    rows = history.withColumn("_cutoffs", cutoffs).select("*", F.posexplode("_cutoffs").alias("_pos", "cutoff"))
    rows = rows.filter(F.col(ds) <= F.date_add("cutoff", horizon))
    return rows.select(
        *history.columns, (F.col("_pos") + 1).alias("fold"), "cutoff", (F.col(ds) <= F.col("cutoff")).alias("is_train")
    )


def fold_sizes(folds: DataFrame, key: str = "symbol") -> DataFrame:
    """Training and test rows per fold."""
    return folds.groupBy(key, "fold", "cutoff").agg(
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows")
    )
