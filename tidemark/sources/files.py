"""CSV and Parquet readers."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.normalize import normalize_bars, union_sources
from tidemark.operators.types import conform, infer_types
from tidemark.sources.storage import exists, first_line, is_directory, list_names

_OPENED_AT_ONCE = 16


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, every column as text; all files must share the header.

    No inference job runs over the data, and typing happens once, in the normaliser, with casts
    that cannot fail the job. A file whose header differs from the first one's is an error
    (``enforceSchema``), never read by position; :func:`csv_families` reads such folders.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    return reader.csv(path)


def csv_families(spark: SparkSession, path: str | list[str]) -> list[tuple[str, list[str]]]:
    """The CSV files below ``path`` by header line: (header, files).

    Opens each file and reads its first line, several files at once; no row is read and no job
    runs. The number of headers is what people wrote by hand; the plan of a reader grows with it,
    not with the number of files.
    """
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_OPENED_AT_ONCE) as pool:
        heads = list(pool.map(lambda file: first_line(spark, file), files))
    families: dict[str, list[str]] = {}
    for file, header in zip(files, heads, strict=True):
        if header is not None:
            families.setdefault(header, []).append(file)
    return sorted(families.items())


def csv_types(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(header, column, inferred, leaning, rows, nulls, conflicts, offender) of all CSV files below ``path``.

    One pass over each header family; see :func:`infer_types`.
    """
    out = None
    for header, files in csv_families(spark, path):
        found = infer_types(read_csv_text(spark, files)).select(F.lit(header).alias("header"), "*")
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise FileNotFoundError(f"no CSV file with a header below {path}")
    return out


def read_csv_typed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, DataFrame]]:
    """The CSV files below ``path``, per header family, with the types that all their values have.

    The types come from a pass over all values, never from a sample, so no value is lost to a cast.
    """
    out = []
    for header, files in csv_families(spark, path):
        raw = read_csv_text(spark, files)
        # One row per column.
        types = {r["column"]: r["inferred"] for r in infer_types(raw).select("column", "inferred").collect()}
        out.append((header, conform(raw, types)))
    return out


def read_bars(spark: SparkSession, path: str | list[str], symbol: str | Column, epoch_unit: str = "s") -> DataFrame:
    """Raw bar CSV to the normalised bar layout; headers may differ in names and order per file.

    ``symbol`` is the series, or an expression over ``_metadata.file_path`` for folders that
    hold many: one scan per header family, however many series there are.
    """
    frames = []
    for _, files in csv_families(spark, path):
        raw = read_csv_text(spark, files)
        if isinstance(symbol, str):
            frames.append(normalize_bars(raw, symbol=symbol, epoch_unit=epoch_unit))
        else:
            frames.append(normalize_bars(raw.withColumn("symbol", symbol), epoch_unit=epoch_unit))
    if not frames:
        raise FileNotFoundError(f"no CSV file with a header below {path}")
    return union_sources(frames)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with partition columns taken from the directory names."""
    return spark.read.parquet(path)


def read_first_available(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The first path that holds data, or ``None`` when there is none."""
    for path in paths:
        if not exists(spark, path):
            continue
        if is_directory(spark, path) and not any(n[0] not in "._" for n in list_names(spark, path)):
            continue
        return read_parquet(spark, path)
    return None
