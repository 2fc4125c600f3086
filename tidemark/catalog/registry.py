"""Query registration and the (spark, sf_dir) calling convention."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("ingest", "quality", "daily", "serving", "reporting", "streams", "forecasts", "rejects", "tables", "fits", "measures")


@dataclass(frozen=True)
class Tables:
    """The Parquet tables of one scale-factor folder."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # Days and NTZ casts are UTC on both sides of the check.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, sf_dir))


_REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        if name in _REGISTERED:
            raise ValueError(f"query {name} registered twice")
        _REGISTERED[name] = Query(build, sql)
        return build

    return register


@lru_cache(maxsize=1)
def _load() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tidemark.catalog.{module}")
    return _REGISTERED


def queries() -> dict[str, Query]:
    return dict(_load())


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in _load().items() if q.sql is not None}
