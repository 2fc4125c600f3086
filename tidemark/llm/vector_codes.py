"""Vector code compression: each vector as one codebook index per part, with exact errors.

Method: active-entry Lloyd. Components are integers, floor(256 x), so all distances and sums
are exact. A stored table holds each vector's parts, their entries and their exact distances.
After an update, a part whose entry stayed fixed compares only the entries that moved: the fixed
ones still are as far as they were and can't win over it. A part whose entry moved looks at all entries
again. Ties go to the lower index in both cases.

Tasks hold the codebooks only (entries x dimensions). An update sums parts per entry inside each task,
so one row per task and entry is shuffled, whatever entry most parts have. Each round is a stored
table: a lost executor repeats its share of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.words import column

SCALE = 256
_ROWS = 4096  # vectors whose distances are held at a time
_STATE = "id long, label {label}, ints binary, codes binary, far binary"


def _packed(values: np.ndarray) -> bytes:
    """One vector's integers in the narrowest of 16, 32 and 64 bits."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64).tobytes()


def _unpacked(blobs: list[bytes], n: int) -> np.ndarray:
    kinds = {2 * n: np.int16, 4 * n: np.int32, 8 * n: np.int64} if n else {0: np.int64}
    if len({len(b) for b in blobs}) == 1:
        return np.frombuffer(b"".join(blobs), dtype=kinds[len(blobs[0])]).reshape(len(blobs), n).astype(np.int64)
    return np.stack([np.frombuffer(b, dtype=kinds[len(b)]).astype(np.int64) for b in blobs])


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts (n x d) and entries (k x d)."""
    d = x.shape[1]
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * d * most * most < 1 << 53:  # doubles hold every term and sum
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1) if len(entries) else np.zeros((len(x), 0), dtype=np.int64)


def full_scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part, the lower index of equal ones, and its distance."""
    far = _distances(x, entries)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(x)), code]


def active_scan(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like full_scan, given code and distance before the entries in ``moved`` (mask) moved."""
    code, far = code.copy(), far.copy()
    lost = moved[code]
    active = np.flatnonzero(moved)
    if not len(active):
        return code, far
    fixed = np.flatnonzero(~lost)
    if len(fixed):
        best, near = full_scan(x[fixed], entries[active])
        best = active[best]
        wins = (near < far[fixed]) | ((near == far[fixed]) & (best < code[fixed]))
        code[fixed[wins]], far[fixed[wins]] = best[wins], near[wins]
    again = np.flatnonzero(lost)
    if len(again):
        code[again], far[again] = full_scan(x[again], entries)
    return code, far


def _integers(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """Integer components, padded with zeros to ``dims``."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ints = np.floor(flat * SCALE)
    if 4 * dims * np.abs(ints).max(initial=0) ** 2 >= 2.0**62:
        raise ValueError("components are too large for errors as long")
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = ints.astype(np.int64)
    return out


def _state(ids: pa.Array, labels: pa.Array, x: np.ndarray, codes: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    blobs = [
        [_packed(row) for row in x.reshape(n, -1)],
        [row.tobytes() for row in codes.astype(np.uint8)],
        [_packed(row) for row in far],
    ]
    return pa.record_batch([ids, labels, *[pa.array(b, pa.binary()) for b in blobs]], names=["id", "label", "ints", "codes", "far"])


def _first(books, dims: int):
    """Map task: vectors to state under the first codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        parts = len(entries)
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(begin, _ROWS)
                x = _integers(column(rows, "vector"), dims).reshape(rows.num_rows, parts, -1)
                both = [full_scan(x[:, p], entries[p]) for p in range(parts)]
                codes, far = (np.stack([b[i] for b in both], axis=1) for i in (0, 1))
                yield _state(column(rows, "id"), column(rows, "label"), x, codes, far)

    return run


def _held(batches: Iterator[pa.RecordBatch], parts: int, dims: int):
    """Blocks of state rows as (rows, parts, codes, distances)."""
    for batch in batches:
        for begin in range(0, batch.num_rows, _ROWS):
            rows = batch.slice(begin, _ROWS)
            x = _unpacked(column(rows, "ints").to_pylist(), dims).reshape(rows.num_rows, parts, -1)
            codes = np.frombuffer(b"".join(column(rows, "codes").to_pylist()), dtype=np.uint8).reshape(-1, parts).astype(np.int64)
            yield rows, x, codes, _unpacked(column(rows, "far").to_pylist(), parts)


def _again(books, moved: np.ndarray, dims: int):
    """Map task: state under the last codebooks to state under the new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        for rows, x, codes, far in _held(batches, len(entries), dims):
            both = [active_scan(x[:, p], entries[p], moved[p], codes[:, p], far[:, p]) for p in range(len(entries))]
            codes, far = (np.stack([b[i] for b in both], axis=1) for i in (0, 1))
            yield _state(column(rows, "id"), column(rows, "label"), x, codes, far)

    return run


def _sums(parts: int, entries: int, dims: int):
    """Map task: number and component sums of the parts of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dims // parts
        n, total = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64)
        for _, x, codes, _ in _held(batches, parts, dims):
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, heads = np.unique(codes[order, p], return_index=True)
                n[p, used] += np.diff(np.append(heads, len(order)))
                total[p, used] += np.add.reduceat(x[order, p], heads, axis=0)
        p, e = np.nonzero(n)
        columns = [p.astype(np.int32), e.astype(np.int32), n[p, e], *total[p, e].T]
        yield pa.record_batch([pa.array(c) for c in columns], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return run


def _updated(state: DataFrame, books: np.ndarray, dims: int) -> np.ndarray:
    """Each used entry replaced by the floor of its parts' mean. Only codebooks come to the driver."""
    parts, entries, width = books.shape
    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long" + "".join(f", {s} long" for s in names)
    sums = state.select("ints", "codes", "far").mapInArrow(_sums(parts, entries, dims), schema)
    out = books.copy()
    for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect():
        out[r["part"], r["entry"]] = [r[s] // r["n"] for s in names]
    return out


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map task: state to hex codes and errors."""
    for batch in batches:
        codes, far = column(batch, "codes").to_pylist(), column(batch, "far").to_pylist()
        error = [int(_unpacked([f], len(c)).sum()) for c, f in zip(codes, far, strict=True)]
        names = ["id", "label", "code", "error"]
        yield pa.record_batch([column(batch, "id"), column(batch, "label"), pa.array([c.hex() for c in codes]), pa.array(error, pa.int64())], names=names)


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(i) for i in books.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, (id, label, code, error, label_error), and the codebooks (parts x entries x width).

    ``code`` has two hex digits per part, ``error`` is the sum of the exact squared distances,
    ``label_error`` the sum of it over rows with an equal label, NULLs together. Codebooks start as
    the vectors of the smallest ids; with fewer vectors than ``entries`` there are fewer
    entries. Vectors that are NULL or hold NULL or non-finite components are left out. Rows that
    share an id each count; where the first codebooks must choose among them, the smaller vector comes
    first; NULL ids come last. Vectors of unequal length, or of a length that ``parts`` doesn't divide, are taken as
    padded with zeros to the longest, rounded up. Errors too large for a long are refused. An empty
    table gives an empty result. Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    label = dict(vectors.dtypes)[label_column]
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(F.col("vector").isNotNull() & ~F.exists("vector", bad)).withColumn("vector", F.col("vector").cast("array<double>"))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = -(-longest // parts) * parts
    seeds = rows.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    start = _integers(pa.array([r["vector"] for r in seeds], pa.list_(pa.float64())), dims)
    books = np.ascontiguousarray(start.reshape(len(seeds), parts, -1 if dims else 0).transpose(1, 0, 2))

    schema = _STATE.format(label=label)
    state = stored(rows.mapInArrow(_first(spark.sparkContext.broadcast(books), dims), schema), "codes")
    for _ in range(rounds):
        new = _updated(state, books, dims)
        moved = (new != books).any(axis=2)
        books = new
        state = stored(state.mapInArrow(_again(spark.sparkContext.broadcast(books), moved, dims), schema), "codes")
    coded = state.select("id", "label", "codes", "far").mapInArrow(_coded, f"id long, label {label}, code string, error long")
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("of")))
    out = joined.select(F.col("id").alias(id_column), F.col("label").alias(label_column), "code", "error", "label_error")
    return out, books
