"""Checkpoints of intermediate tables in the folder the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once below ``spark.checkpoint.dir`` and read it back.

    Several readers then share one result, and lineage ends here: what a lost executor held is
    read again, not computed again.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, df: DataFrame, per_part: int, least: int | None = None) -> int:
    """Number of hash parts such that each holds about ``per_part`` bytes of the input.

    Uses the planner's size estimate (file sizes), never a pass over the data, and at least the
    session's shuffle partitions.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = least or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-size // per_part), 1_000_000) if size < 1 << 60 else least)


def fixed_sample(df: DataFrame, n: int, id_column: str = "id") -> DataFrame:
    """At most ``n`` rows, those with the lowest hash of the id: the same at every run and layout.

    Only hashes are ranked; the rows themselves are read again by the limit found.
    """
    rank = F.xxhash64(id_column)
    last = df.select(rank.alias("r")).orderBy("r").limit(n).agg(F.max("r")).first()[0]
    if last is None:
        return df.limit(0)
    return df.filter(rank <= last).limit(n)
