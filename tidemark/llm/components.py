"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest neighbour of u. The minimum is combined before the shuffle."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _least(both).withColumn("m", F.least("m", "u"))
    return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _least(edges)  # u > v always
    out = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b: long); component is its smallest reachable id.

    Rounds end when nothing changes, after about log(longest path) of them. Each round is one
    stored table of at most as many rows as there were links.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = stored(links.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)), "stars")
        # Stars are stable when their checksum is.
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
