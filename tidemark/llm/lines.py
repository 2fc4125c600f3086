"""Line dedup: a line that many documents hold stays in the one with the largest id.

Method: a sharded minimal perfect hash over the hashes of repeated lines, with arrays of
fingerprints, counts and keepers (``line_index``); documents probe these arrays.

Jobs:

1. Map tasks hash each line once, put equal ones together and send, per line, the number of
   texts and the ``least`` largest ids: enough to know whether ``least`` documents hold it and
   which one keeps it, however often it occurs. Lines that a block holds often stay in the task
   until its end, so a line that every text holds costs a few rows a task.
2. Each shard sorts its hashes, leaves out lines of fewer documents and writes its arrays as one row.
3. The arrays of the most frequent lines, ``IN_TASK`` at most, are broadcast; documents
   probe them in one pass and nothing is shuffled. If there are more lines, the rest are probed at their
   shards: texts send the hashes there and get back what to drop. No key of that exchange is hot, since the frequent
   lines are settled by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.line_index import SHARD_SCHEMA, LineIndex, row_lines, shard_row
from tidemark.llm.storage import parts, stored
from tidemark.llm.words import U64, column, portions

SPACES = b" \t\n\x0b\x0c\r"
# Most frequent lines that every task holds: 24 bytes and 4 bits each.
IN_TASK = 1_000_000
_BLOCK_LINES = 200_000
_OFTEN = 8
_CONTINUED = bytes(range(0x80, 0xC0))


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def line_hash(line: bytes, chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a key below ``chars`` code points.

    The key is the line without the spaces at its ends, in lower case (A-Z).
    """
    key = line.strip(SPACES).lower()
    if len(key) < chars or len(key) < 4 * chars and len(key.translate(None, _CONTINUED)) < chars:
        return None
    return _hash(key)


def _numbers(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), dtype=U64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _top(ids: list[int], other: int, least: int) -> None:
    """Put an id among the ``least`` largest different ones, in place."""
    if other not in ids and (len(ids) < least or other > ids[-1]):
        ids.append(other)
        ids.sort(reverse=True)
        del ids[least:]


def _count(chars: int, least: int, shards: int):
    """Map task: (shard, first, second, n, id) per line of a block, one row per id kept."""

    def emit(found: dict) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        first, second = _numbers(list(found))
        sizes = [len(ids) for _, ids in found.values()]
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        n = np.zeros(sum(sizes), dtype=np.int64)
        n[heads] = [n for n, _ in found.values()]  # on the first row of a line
        out = [np.repeat((first % U64(shards)).astype(np.int32), sizes)]
        out += [np.repeat(x.astype(np.int64), sizes) for x in (first, second)]
        out += [n, np.array([i for _, ids in found.values() for i in ids], dtype=np.int64)]
        batch = pa.record_batch([pa.array(c) for c in out], names=["shard", "first", "second", "n", "id"])
        for begin in range(0, batch.num_rows, 50_000):
            yield batch.slice(begin, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, tuple[int, list[int]]] = {}
        for batch, texts in portions(batches, "text"):
            for i, text in zip(column(batch, "id").to_pylist(), texts, strict=True):
                if i is None or not text:
                    continue
                for h in {line_hash(line, chars) for line in text.split(b"\n")} - {None}:
                    n, ids = found.get(h) or (0, [])
                    _top(ids, i, least)
                    found[h] = (n + 1, ids)
            if len(found) > _BLOCK_LINES:
                often = {h: x for h, x in found.items() if x[0] >= _OFTEN}
                if 2 * len(often) > _BLOCK_LINES:
                    often = {}
                yield from emit({h: x for h, x in found.items() if h not in often})
                found = often
        yield from emit(found)

    return run


def _build(least: int):
    """One shard: lines of ``least`` documents, as arrays."""

    def run(table: pa.Table) -> pa.Table:
        first, second, n, ids = (table.column(c).to_numpy() for c in ("first", "second", "n", "id"))
        order = np.lexsort((-ids, second, first))  # ids are above -2**63, see line_index()
        first, second, n, ids = first[order].astype(U64), second[order].astype(U64), n[order], ids[order]
        new_line = np.ones(len(first), dtype=bool)
        new_line[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new_id = new_line.copy()
        new_id[1:] |= ids[1:] != ids[:-1]
        heads = np.flatnonzero(new_line)
        documents, texts = np.add.reduceat(new_id.astype(np.int64), heads), np.add.reduceat(n, heads)
        kept = documents >= least
        heads = heads[kept]
        row = shard_row(table.column("shard")[0].as_py(), first[heads], second[heads], texts[kept], ids[heads])
        return pa.Table.from_pylist([row] if len(heads) else [], schema=_SHARD)

    return run


_SHARD = pa.schema(
    [("shard", pa.int32()), ("lines", pa.int64())] + [(c, pa.binary()) for c in ("sizes", "bits", "heads", "prints", "counts", "keepers")]
)


def line_index(docs: DataFrame, shards: int, chars: int = 20, least: int = 3) -> DataFrame:
    """Arrays of the lines that at least ``least`` documents hold, one row per shard that has any.

    ``docs`` has ``id`` (long) and ``text``.
    """
    rows = docs.select("id", "text").mapInArrow(_count(chars, least, shards), "shard int, first long, second long, n long, id long")
    return rows.groupBy("shard").applyInArrow(_build(least), SHARD_SCHEMA)


def _thin(index: DataFrame, from_count: int, below: int | None = None) -> DataFrame:
    """The same arrays for lines with a count in that range only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, second, counts, keepers = row_lines(row)
                in_ = counts >= from_count
                if below is not None:
                    in_ &= counts < below
                if in_.any():
                    thin = shard_row(row["shard"], first[in_], second[in_], counts[in_], keepers[in_])
                    yield pa.RecordBatch.from_pylist([thin], schema=_SHARD)

    return index.mapInArrow(run, SHARD_SCHEMA)


def _histogram(index: DataFrame) -> list[tuple[int, int]]:
    """(power of two, number of lines whose count reaches it but not the next one), largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(64, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                total += np.bincount(np.log2(row_lines(row)[2]).astype(np.int64), minlength=64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["power", "lines"])

    found = index.select(*_SHARD.names).mapInArrow(run, "power long, lines long").groupBy("power").agg(F.sum("lines").alias("lines")).collect()
    return sorted(((1 << r["power"], r["lines"]) for r in found), reverse=True)


def _settle(hot, shards: int, chars: int, own_key: bool):
    """Map task over documents: drop what the arrays in hand say, and what ``gone`` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex(hot.value, shards)
        for batch, texts in portions(batches, "text"):
            ids = column(batch, "id").to_pylist()
            gone = column(batch, "gone").to_pylist() if own_key else None
            lines = [(text or b"").split(b"\n") for text in texts]
            hashes = [line_hash(line, chars) for ls in lines for line in ls]
            asked = [k for k, h in enumerate(hashes) if h]
            drop = np.zeros(len(hashes), dtype=bool)
            if asked:
                at = np.array(asked)
                owner = np.repeat(np.arange(len(ids)), [len(ls) for ls in lines])[at]
                numbers = index.probe(*_numbers([hashes[k] for k in asked]))
                hit = np.flatnonzero(numbers >= 0)
                keepers = index.keepers[numbers[hit]].tolist()
                drop[at[hit]] = [ids[o] != k for o, k in zip(owner[hit].tolist(), keepers, strict=True)]
                if own_key:
                    told = [frozenset(g or ()) for g in gone]
                    drop[at] |= np.array([hashes[k] in told[o] for k, o in zip(asked, owner.tolist(), strict=True)], dtype=bool)
            kept, dropped, k = [], [], 0
            for ls in lines:
                out = drop[k : k + len(ls)]
                dropped.append(int(out.sum()))
                kept.append(b"\n".join([line for line, o in zip(ls, out.tolist(), strict=True) if not o]) if dropped[-1] else b"\n".join(ls))
                k += len(ls)
            yield pa.record_batch(
                [
                    column(batch, "id"),
                    pa.array([len(ls) for ls in lines], pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept]),
                ],
                names=["id", "n_lines", "n_dropped", "kept_text", "kept_sha256"],
            )

    return run


def _row_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a 128-bit key of id and text: equal rows share it, others don't."""
    for batch, texts in portions(batches, "text"):
        ids = column(batch, "id").to_pylist()
        keys = [_hash(f"{i}:".encode() + (b"0" if t is None else b"1" + t)) for i, t in zip(ids, texts, strict=True)]
        yield pa.record_batch([column(batch, "id"), column(batch, "text"), pa.array(keys, pa.binary())], names=["id", "text", "key"])


def _ask(hot, shards: int, chars: int):
    """Map task: (shard, key, id, first, second) of each line that the arrays in hand don't know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex(hot.value, shards)
        for batch, texts in portions(batches, "text"):
            own = [list({line_hash(line, chars) for line in (t or b"").split(b"\n")} - {None}) for t in texts]
            sizes = np.array([len(o) for o in own])
            if not sizes.sum():
                continue
            first, second = _numbers([h for o in own for h in o])
            owner = np.repeat(np.arange(len(own)), sizes)
            open_ = np.flatnonzero(index.probe(first, second) < 0)
            first, second, owner = first[open_], second[open_], owner[open_]
            yield pa.record_batch(
                [
                    pa.array((first % U64(shards)).astype(np.int32)),
                    column(batch, "key").take(pa.array(owner)),
                    column(batch, "id").take(pa.array(owner)),
                    pa.array(first.astype(np.int64)),
                    pa.array(second.astype(np.int64)),
                ],
                names=["shard", "key", "id", "first", "second"],
            )

    return run


def _answer(shards: int):
    """One shard: which of the lines asked for must go from which row."""

    def run(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        none = {"key": pa.array([], pa.binary()), "hash": pa.array([], pa.binary())}
        if not asked.num_rows or not arrays.num_rows:
            return pa.table(none)
        index = LineIndex(arrays.to_pylist(), shards)
        first, second = (asked.column(c).to_numpy().astype(U64) for c in ("first", "second"))
        numbers = index.probe(first, second)
        hit = np.flatnonzero(numbers >= 0)
        ids = asked.column("id").take(pa.array(hit)).to_pylist()
        hit = hit[[i != k for i, k in zip(ids, index.keepers[numbers[hit]].tolist(), strict=True)]] if len(hit) else hit
        hashes = [np.array(pair, dtype=U64).tobytes() for pair in zip(first[hit], second[hit], strict=True)]
        return pa.table({"key": asked.column("key").combine_chunks().take(pa.array(hit)), "hash": pa.array(hashes, pa.binary())})

    return run


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chars: int = 20, least: int = 3) -> DataFrame:
    """Documents without the lines that ``least`` or more of them hold, but for the keeper's.

    Returns (id, n_lines, n_dropped, kept_text, kept_sha256), one row per input row. A line
    ends at \\n; lines are equal if their keys are: spaces at both ends gone, A-Z in lower case.
    Keys below ``chars`` code points always stay. A repeated line stays, as often as it stands there, in the
    document with the largest id that holds it. A NULL or empty text is one empty line. Rows that
    share an id are one document; equal rows get equal results. A row with a NULL id counts as no
    document and keeps no repeated line. Ids are whole numbers above -2**63. Very long texts are read
    whole, an empty table gives an empty result, other columns are ignored.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_column]
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    shards = parts(spark, docs, 16 << 20)
    index = stored(line_index(docs, shards, chars, least), "lines")
    from_count, held, total = None, 0, 0
    for count, lines in _histogram(index):
        total += lines
        if total <= IN_TASK:
            from_count, held = count, total
    frequent = _thin(index, from_count).drop("heads").collect() if held else []
    hot = spark.sparkContext.broadcast([r.asDict() for r in frequent])
    out = "id long, n_lines long, n_dropped long, kept_text string, kept_sha256 string"
    if held == total:
        kept = docs.mapInArrow(_settle(hot, shards, chars, False), out)
    else:
        rare = stored(_thin(index, 0, from_count), "rare-lines")
        keyed = docs.mapInArrow(_row_key, "id long, text string, key binary")
        asked = keyed.mapInArrow(_ask(hot, shards, chars), "shard int, key binary, id long, first long, second long")
        gone = asked.groupBy("shard").cogroup(rare.groupBy("shard")).applyInArrow(_answer(shards), "key binary, hash binary")
        # At most as many as the row has lines.
        gone = gone.groupBy("key").agg(F.collect_list("hash").alias("gone"))
        joined = keyed.join(gone, "key", "left").select("id", "text", "gone")
        kept = joined.mapInArrow(_settle(hot, shards, chars, True), out)
    return kept.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_column)
