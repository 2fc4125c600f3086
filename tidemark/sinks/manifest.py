"""Several tables published together, year by year, behind one small manifest.

Layout below the root of a set::

    <table>/gen=000007/year=2024/part-...    data; a folder is written once and never changed
    _manifests/000007.json                   which generation holds each year of each table

A publication writes only the years that changed, for all tables, and then adds one manifest. Readers
take the newest manifest, so they see either all tables as they were or all as they are now, and the
files of untouched years stay the same files. Work of a publication follows the years it
touches, not those stored. Only names travel through the driver: one entry per table and year.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import require_columns
from tidemark.sinks.tables import write_partitioned
from tidemark.sources.storage import list_names, move_new, read_text, remove_tree, write_text

YEAR = "year"
_NUMBER = re.compile(r"^(\d{6,})\.json$")


class PublishConflict(RuntimeError):
    """Someone else published to the set meanwhile."""


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifests"


def manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests of a set, oldest first."""
    return sorted(int(m.group(1)) for m in map(_NUMBER.match, list_names(spark, _folder(root))) if m)


def read_manifest(spark: SparkSession, root: str, back: int = 0) -> dict | None:
    """The newest manifest, or the one ``back`` publications before it."""
    known = manifest_numbers(spark, root)
    if len(known) <= back:
        return None
    number = known[-1 - back]
    return json.loads(read_text(spark, f"{_folder(root)}/{number:06d}.json")) | {"number": number}


def _year_path(root: str, table: str, generation: int, year: int | None = None) -> str:
    path = f"{root.rstrip('/')}/{table}/gen={generation:06d}"
    return path if year is None else f"{path}/{YEAR}={year}"


def read_published(
    spark: SparkSession, root: str, table: str, years: Sequence[int] | None = None, back: int = 0, manifest: dict | None = None
) -> DataFrame | None:
    """One table of the set as last published; ``None`` before the first publication.

    ``years`` restricts the read to some folders. With ``manifest`` the caller reads several tables of the same publication.
    """
    manifest = manifest or read_manifest(spark, root, back)
    if manifest is None or table not in manifest["tables"]:
        return None
    held = {int(y): g for y, g in manifest["tables"][table]["years"].items()}
    schema = T.StructType.fromJson(manifest["tables"][table]["schema"])
    paths = [_year_path(root, table, g, y) for y, g in sorted(held.items()) if years is None or y in set(years)]
    if not paths:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/{table}"
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame | Callable[[DataFrame], DataFrame]],
    years: Mapping[str, Sequence[int]] | None = None,
    settings: Mapping | None = None,
    sort_by: Mapping[str, Sequence[str]] | None = None,
    after: int | None = None,
    keep: int = 2,
) -> int:
    """Write ``tables`` (each with a ``year`` column) and make them the published state in one step.

    With ``years`` the frames hold the new content of just these years of each table, and a year
    without rows there is gone; the other years keep their files. Without, the frames are whole
    tables. A table may be a function of the first one, which it gets as written: its new rows are
    then computed once. ``after`` is the manifest that the frames were computed from: if it is no
    longer the newest, nothing is published and :class:`PublishConflict` is raised. ``settings`` are kept with the manifest; the old ones stay
    unless given. Folders that the newest ``keep`` manifests don't name are removed.
    """
    known = manifest_numbers(spark, root)
    newest = known[-1] if known else None
    if after is not None and after != newest:
        raise PublishConflict(f"manifest {newest} came after {after}")
    old = read_manifest(spark, root) or {"tables": {}, "settings": {}}
    number = (newest or 0) + 1
    new = {"settings": {**old["settings"], **(settings or {})}, "tables": dict(old["tables"])}
    first = None
    for name, made in tables.items():
        df = made(first) if callable(made) else made
        require_columns(df, [YEAR], "publish")
        df = df.withColumn(YEAR, F.col(YEAR).cast("int"))
        if years is not None:
            df = df.filter(F.col(YEAR).isin([int(y) for y in years[name]]))
        # A folder of an attempt that died has this number too; it is replaced here.
        target = _year_path(root, name, number)
        write_partitioned(df, target, (YEAR,), sort_by=(sort_by or {}).get(name, ()))
        written = {n.split("=", 1)[1]: number for n in list_names(spark, target) if n.startswith(f"{YEAR}=")}
        before = old["tables"].get(name, {}).get("years", {}) if years is not None else {}
        stay = {y: g for y, g in before.items() if int(y) not in set(years[name])} if years is not None else {}
        new["tables"][name] = {"years": stay | written, "schema": json.loads(df.schema.json())}
        if first is None:
            first = spark.read.schema(df.schema).parquet(target).select(*df.columns)
    draft = f"{_folder(root)}/_draft-{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(new))
    if not move_new(spark, draft, f"{_folder(root)}/{number:06d}.json"):
        remove_tree(spark, draft)
        raise PublishConflict(f"manifest {number} exists")
    _sweep(spark, root, keep)
    return number


def _sweep(spark: SparkSession, root: str, keep: int) -> None:
    """Remove manifests older than the newest ``keep``, and year folders that no kept one names."""
    known = manifest_numbers(spark, root)
    kept = [read_manifest(spark, root, back) for back in range(min(max(keep, 1), len(known)))]
    named = {_year_path(root, t, g, int(y)) for m in kept for t, held in m["tables"].items() for y, g in held["years"].items()}
    tables = {t for m in kept for t in m["tables"]}
    for table in tables:
        for gen in list_names(spark, f"{root.rstrip('/')}/{table}"):
            path = f"{root.rstrip('/')}/{table}/{gen}"
            # A generation above the newest manifest may be one that is being written.
            if not gen.startswith("gen=") or int(gen[4:]) > known[-1]:
                continue
            held = [n for n in list_names(spark, path) if n.startswith(f"{YEAR}=")]
            gone = [n for n in held if f"{path}/{n}" not in named]
            if len(gone) == len(held):
                remove_tree(spark, path)
            else:
                for name in gone:
                    remove_tree(spark, f"{path}/{name}")
    for number in known[: -max(keep, 1)]:
        remove_tree(spark, f"{_folder(root)}/{number:06d}.json")
