"""Parquet and CSV tables.

A table that is computed from its own previous content is written as a new version beside
the old one (:func:`write_version`); nothing ever overwrites a path it is reading.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import require_columns
from tidemark.sources.storage import exists, list_names, remove_tree, scratch_dir

BAR_LAYOUT = ("symbol", "year", "month")
# Daily tables have folders per year and rows sorted by series: the number of folders follows the
# years, not the series, and file statistics prune by series.
DAILY_LAYOUT = ("year",)
DAILY_ORDER = ("symbol", "date")
_VERSION = re.compile(r"^version=(\d{6,})$")


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # REBALANCE gives each table partition few files, yet lets AQE split a partition that is
    # too big for one task: a symbol with a third of the rows is written by many tasks.
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = BAR_LAYOUT,
    only_touched: bool = False,
    sort_by: Sequence[str] = (),
) -> None:
    """Overwrite ``path``; with ``only_touched`` replace just the partitions present in ``df``.

    ``sort_by`` orders the rows inside the files.
    """
    require_columns(df, partition_by, "write_partitioned")
    mode = "dynamic" if only_touched else "static"
    packed = _clustered(df, partition_by)
    if sort_by:
        packed = packed.sortWithinPartitions(*partition_by, *sort_by)
    packed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, partition_by: Sequence[str] = BAR_LAYOUT) -> DataFrame:
    """A table of partition folders with the folders' names as text, whatever the session infers: ``007`` stays ``007``."""
    held = [f for f in spark.read.parquet(path).schema.fields if f.name not in partition_by]
    kind = T.StructType([*held, *[T.StructField(c, T.StringType()) for c in partition_by]])
    return spark.read.schema(kind).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str]) -> None:
    """Overwrite ``path`` without partition folders: rows of a key lie together and sorted."""
    require_columns(df, cluster_by, "write_clustered")
    _clustered(df, cluster_by[:1]).sortWithinPartitions(*cluster_by).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, ordered: bool = False) -> None:
    """CSV with a header, in few, evenly sized files that AQE chooses by size.

    The rebalance comes after the last stage, which keeps its own parallelism.  ``ordered`` is
    for top-n results: they are a few rows in one task already, and keep their order.
    """
    packed = df if ordered else df.hint("rebalance")
    packed.write.mode("overwrite").option("header", True).csv(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    For a costly result that several branches use: they read files, whatever executors are
    lost meanwhile, instead of each computing it again.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_staging(df: DataFrame, root: str, batch_id: str) -> str:
    """One unpartitioned Parquet folder per fetch batch; a repeated batch replaces itself."""
    path = f"{root.rstrip('/')}/{batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions of a table, oldest first. A version counts once its job committed."""
    found = []
    for name in list_names(spark, root):
        match = _VERSION.match(name)
        if match and exists(spark, f"{root}/{name}/_SUCCESS"):
            found.append(int(match.group(1)))
    return sorted(found)


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/version={number:06d}"


def read_version(spark: SparkSession, root: str, back: int = 0) -> DataFrame | None:
    """The newest committed version, or the one ``back`` versions before it."""
    known = versions(spark, root)
    return spark.read.parquet(version_path(root, known[-1 - back])) if len(known) > back else None


def write_version(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = DAILY_LAYOUT,
    cluster_by: Sequence[str] = (),
    keep: int = 2,
) -> str:
    """Write the next version, then drop versions older than the newest ``keep``.

    Readers see the old version until the job commits its success marker. An attempt that
    died leaves an uncommitted folder, which the next write replaces. ``cluster_by`` is for
    tables without partition folders: rows of a key lie together, so file statistics prune,
    however many keys there are.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    path = version_path(root, known[-1] + 1 if known else 1)
    if partition_by:
        write_partitioned(df, path, partition_by, sort_by=[c for c in DAILY_ORDER if c in df.columns and c not in partition_by])
    elif cluster_by:
        write_clustered(df, path, cluster_by)
    else:
        _clustered(df, ()).write.mode("overwrite").parquet(path)
    drop_versions(spark, root, keep)
    return path


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove committed versions older than the newest ``keep``; the newest always stays."""
    for old in versions(spark, root)[: -max(keep, 1)]:
        remove_tree(spark, version_path(root, old))
