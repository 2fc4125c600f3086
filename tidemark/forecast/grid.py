"""Candidate configurations, one copy of a series per candidate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    config_id: int
    mode: str
    prior: float


# Seasonality modes and changepoint priors that are searched.
MODES = ("additive", "multiplicative")
PRIORS = (0.01, 0.05, 0.1)
DEFAULT_GRID = tuple(Config(i, m, p) for i, (m, p) in enumerate(product(MODES, PRIORS), start=1))


def with_configs(df: DataFrame, grid: Sequence[Config] = DEFAULT_GRID) -> DataFrame:
    """Every row once per candidate, as columns (config_id, mode, prior)."""
    literals = [
        F.struct(F.lit(c.config_id).alias("config_id"), F.lit(c.mode).alias("mode"), F.lit(c.prior).alias("prior"))
        for c in grid
    ]
    return df.withColumn("_config", F.explode(F.array(*literals))).select("*", "_config.*").drop("_config")
