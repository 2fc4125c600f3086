"""Embedding near-dedup: links and classes of vectors above a cosine, exact.

Method: int8 tile products with error bounds. A unit vector x is s * q + e with integers q in
-127..127, and the length of e is known. So for two vectors

    |x.y - s_x s_y (q_x.q_y)| <= |e_x| + (1 + |e_x|) |e_y|,

and only pairs whose integer product could reach the threshold are computed again in double
precision. Vectors lie in blocks by a hash of their id, and each pair of blocks is one task: every
pair of rows meets in exactly one of them. Integer products run as single-precision matrix
products, which are exact for these sizes (127 * 127 * 1024 < 2**24).

Equal vectors are put together first, so a vector that a third of the rows share counts once. A tile
answers with sums of links and a spanning set of its links, never with all pairs. The work is the
square of the number of different vectors: exactness for any data leaves no tile out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.storage import stored

BLOCK = 4096
_STRIPE = 512  # rows of a tile that are held as products at a time
_DIMS = 1024  # exact in single precision
_SLACK = 1e-9  # rounding of the bounds themselves


def _pack(table: pa.Table) -> pa.Table:
    """One block: ids, numbers of copies, vectors, quantised vectors, scales and error lengths."""
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in table.column("embedding").to_pylist()])
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(units).max(axis=1) / 127
    ints = np.rint(units / scale[:, None])
    error = np.linalg.norm(units - scale[:, None] * ints, axis=1) + _SLACK
    blobs = {
        "ids": table.column("vec_id").to_numpy().astype(np.int64),
        "copies": table.column("copies").to_numpy().astype(np.int64),
        "vectors": vectors,
        "ints": ints.astype(np.int8),
        "scale": scale,
        "error": error,
    }
    keys = {c: pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("dims", "block")}
    return pa.table({**keys, **{k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()}})


_BLOCKS = "dims int, block int, ids binary, copies binary, vectors binary, ints binary, scale binary, error binary"


class _Block:
    def __init__(self, row: dict, dims: int):
        self.ids, self.copies = (np.frombuffer(row[k], dtype=np.int64) for k in ("ids", "copies"))
        vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, dims)
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.ints = np.frombuffer(row["ints"], dtype=np.int8).reshape(-1, dims).astype(np.float32)
        self.scale, self.error = (np.frombuffer(row[k], dtype=np.float64) for k in ("scale", "error"))


def _hits(a: _Block, b: _Block, rows: slice, threshold: float) -> np.ndarray:
    """Which pairs of these rows of a with all of b reach the threshold (boolean matrix)."""
    dots = a.ints[rows, :_DIMS] @ b.ints[:, :_DIMS].T
    for d in range(_DIMS, a.ints.shape[1], _DIMS):
        dots = dots.astype(np.float64) + a.ints[rows, d : d + _DIMS] @ b.ints[:, d : d + _DIMS].T
    # A bound for the whole stripe first, each pair's own after it.
    scale, error = a.scale[rows], a.error[rows]
    most = error.max() + (1 + error.max()) * b.error.max()
    least = ((threshold - most) / scale.max() / b.scale).astype(np.float32)
    near, far = np.nonzero(dots >= np.minimum(least, least * np.float32(1 - 1e-6))[None, :])
    value = scale[near] * b.scale[far] * dots[near, far].astype(np.float64)
    open_ = value + error[near] + (1 + error[near]) * b.error[far] >= threshold
    near, far = near[open_], far[open_]
    out = np.zeros(dots.shape, dtype=bool)
    if len(near) > dots.size // 50:
        out[near, far] = True
        return out & (a.vectors[rows] @ b.vectors.T >= threshold)
    for i in range(0, len(near), 1 << 16):
        x, y = near[i : i + (1 << 16)], far[i : i + (1 << 16)]
        out[x, y] = np.einsum("ij,ij->i", a.vectors[rows][x], b.vectors[y]) >= threshold
    return out


def _tile(threshold: float):
    """One pair of blocks (or a block with itself): (id, root, links) for each vector with a link."""

    def run(table: pa.Table) -> pa.Table:
        both = sorted(table.to_pylist(), key=lambda r: r["block"])
        dims = both[0]["dims"]
        a, b = _Block(both[0], dims), _Block(both[-1], dims)
        own = len(both) == 1
        size = len(a.ids)
        ids = a.ids if own else np.concatenate([a.ids, b.ids])
        shift = 0 if own else size
        links = np.zeros(len(ids), dtype=np.int64)
        label = np.arange(len(ids))
        for begin in range(0, size, _STRIPE):
            rows = slice(begin, min(begin + _STRIPE, size))
            hit = _hits(a, b, rows, threshold)
            if own:
                hit[np.arange(hit.shape[0]), np.arange(begin, rows.stop)] = False
            links[rows] += hit @ b.copies
            if not own:
                links[size:] += a.copies[rows] @ hit
            for r in np.flatnonzero(hit.any(axis=1)):
                labels = np.unique(np.append(label[np.flatnonzero(hit[r]) + shift], label[begin + r]))
                if len(labels) > 1:
                    label[np.isin(label, labels)] = labels[0]
        some = np.flatnonzero(links)
        return pa.table({"id": pa.array(ids[some]), "root": pa.array(ids[label[some]]), "links": pa.array(links[some])})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per vector.

    n_links counts the other vectors with a cosine of ``threshold`` or more, in double precision;
    component_id is the smallest id reachable by links, itself included; kept is true for that one.
    Vectors that are NULL, empty or zero, or hold NULL or non-finite numbers, link with nothing.
    Vectors of different lengths don't link. Equal rows link with each other; ids are integers, and rows
    that share an id also share its links and component. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    # -0.0 and 0.0 are one number; F.exists is NULL-free after the first test.
    rows = rows.withColumn("embedding", F.when(usable, F.transform("embedding", lambda x: x + F.lit(0.0))))
    distinct = stored(rows.filter("embedding is not null").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    n_blocks = max(1, -(-distinct.count() // BLOCK))
    block = F.pmod(F.xxhash64("rep", "embedding"), F.lit(n_blocks)).cast("int")
    packed = (
        distinct.select(F.size("embedding").alias("dims"), block.alias("block"), F.col("rep").alias("vec_id"), "copies", "embedding")
        .groupBy("dims", "block")
        .applyInArrow(_pack, _BLOCKS)
    )
    tiles = stored(packed, "blocks").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    tiles = tiles.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    # A missing block (of another length, or empty) leaves a group with one row of a pair: it is no tile.
    found = stored(tiles.groupBy("dims", "low", "high").applyInArrow(_pairs(threshold), "id long, root long, links long"), "tiles")
    # Different vectors of one id, and copies that share a vector, belong together.
    ties = distinct.join(rows, "embedding").select(F.col("rep").alias("a"), F.col("vec_id").alias("b")).filter("a <> b").distinct()
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).filter("a <> b").unionByName(ties))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_row = (
        rows.join(distinct, "embedding", "left")
        .join(links, F.col("rep") == F.col("id"), "left")
        .groupBy("vec_id")
        .agg(F.sum(F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"), F.count("*").alias("rows"))
        .join(classes, F.col("vec_id") == F.col("id"), "left")
        .select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"), "rows")
    )
    return of_row.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).select(
        F.col("vec_id").alias(id_column), "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )


def _pairs(threshold: float):
    tile = _tile(threshold)

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        if table.num_rows != (1 if low == high else 2):
            return pa.table({k: pa.array([], pa.int64()) for k in ("id", "root", "links")})
        return tile(table.drop_columns(["low", "high"]))

    return run
