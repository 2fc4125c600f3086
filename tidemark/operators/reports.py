"""Report tables over the gap-free daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact_mean, pct_change
from tidemark.operators.calendar import period_mean


def top_price_change_days(daily: DataFrame, top: int = 10) -> DataFrame:
    """Largest absolute open-to-close moves; ties by symbol and date."""
    change = F.round(F.abs(pct_change("daily_open", "daily_close")), 6).alias("price_change_percent")
    changes = daily.select("symbol", "date", change)
    return changes.orderBy(F.desc_nulls_last("price_change_percent"), "symbol", "date").limit(top)


def top_volume_days(daily: DataFrame, top: int = 10) -> DataFrame:
    columns = daily.select("symbol", "date", "daily_volume")
    return columns.orderBy(F.desc_nulls_last("daily_volume"), "symbol", "date").limit(top)


def avg_volume_per_month(daily: DataFrame, scale: int | None = None) -> DataFrame:
    return period_mean(daily, "daily_volume", F.date_format("date", "yyyy-MM"), "month", "avg_volume", scale=scale)


def avg_return_per_year(daily: DataFrame, scale: int | None = None) -> DataFrame:
    returns = daily.select("symbol", "date", pct_change("daily_open", "daily_close").alias("_return"))
    return period_mean(returns, "_return", F.year("date"), "year", "avg_return", scale=scale)


def last_n(df: DataFrame, n: int = 90, key: str = "symbol", date: str = "date") -> DataFrame:
    """The newest ``n`` rows of each series; the rank limit runs before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.desc(date))
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def error_histogram(
    errors: DataFrame, low: float, high: float, bins: int, value: str = "pct_error", key: str = "symbol"
) -> DataFrame:
    """Counts per equal-width bin; bin 0 and bin ``bins + 1`` hold everything outside the range."""
    bucket = F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(bins)).cast("bigint")
    return errors.filter(F.col(value).isNotNull()).groupBy(key, bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def model_kpis(metrics: DataFrame, key: str = "symbol", scale: int | None = None) -> DataFrame:
    """Number of series, mean error and the series with the smallest error."""
    scored = F.when(F.col("mape").isNotNull(), F.struct("mape", key))
    return metrics.agg(
        F.count(F.lit(1)).alias("n_symbols"),
        exact_mean("mape", scale).alias("mean_mape"),
        F.min_by(key, scored).alias("best_symbol"),
    )
