"""Substring dedup: remove every word that lies in a repeated window of words.

Method: super-k-mers. Each window of ``window`` words has a minimiser, its lowest-ranked run of
``RUN`` words. Consecutive windows with one minimiser travel as a single packed string to the
bucket of that minimiser, so a window's copies all meet in one bucket, where sorting counts them.

Jobs:

1. Count minimisers in every document and keep the frequent ones (a bounded list). They rank last,
   so a common phrase is the minimiser only of windows that consist of common phrases; otherwise
   each document's own words decide the bucket. The list changes balance, never results.
2. Each map block packs its super-k-mers by bucket. A string that occurs twice in the block is
   already known to repeat: its places are settled there and one copy, marked, goes on. So a
   passage that a third of all rows share sends one string per block, not one per row.
3. Each bucket sorts its windows and answers with word spans per document.
4. Documents join their spans by key and drop the covered words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import parts
from tidemark.llm.words import U64, Words, column, mix, portions, runs_hash, windows_hash

RUN = 4
# At most this many frequent minimisers rank last; 8 bytes each are sent to every task.
MOST_FREQUENT = 50_000
_LAST = U64(1 << 63)
_BLOCK_BYTES = 24 << 20


def _low(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Rank of each run of RUN words: its hash, frequent ones behind all others."""
    ranks = runs_hash(hashes, RUN) & ~_LAST
    if len(frequent) and len(ranks):
        at = np.minimum(np.searchsorted(frequent, ranks), len(frequent) - 1)
        ranks[frequent[at] == ranks] |= _LAST
    return ranks


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    if have < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - have :])
    return out


def _runs(words: Words, window: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: first word, number of windows, minimiser."""
    low = _sliding_min(_low(words.hashes, frequent), window - RUN + 1)
    at = np.flatnonzero(words.left() >= window)
    if not len(at):
        return at, at, low[:0]
    low = low[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])
    heads = np.flatnonzero(new)
    return at[heads], np.diff(np.append(heads, len(at))), low[heads]


def _frequent(docs: DataFrame, window: int) -> np.ndarray:
    """Minimisers that occur in many super-k-mers, most frequent first, sorted by value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, texts in portions(batches, "text"):
            held.append(_runs(Words(texts), window, np.zeros(0, dtype=U64))[2])
        if held:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= 4
            yield pa.record_batch([pa.array(values[many].astype(np.int64)), pa.array(times[many])], names=["low", "n"])

    top = (
        docs.select("text")
        .mapInArrow(count, "low long, n long")
        .groupBy("low")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "low")
        .limit(MOST_FREQUENT)
        .collect()
    )
    return np.sort(np.array([r["low"] for r in top], dtype=np.int64).astype(U64))


_PACKED = "bucket int, strings binary, settled binary, keys binary, places binary, spans binary"


def _pack(window: int, buckets: int, frequent):
    """Map task: documents (key, text) to packed super-k-mers by bucket.

    A row has the distinct strings of one block and bucket, a flag for those that the block has
    twice or more (``settled``), key and place of each other one, and spans that are settled.
    """

    def flush(held: list[dict]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        known: list[list[int]] = [[] for _ in range(buckets)]  # settled spans go by key, not by string
        rows = []
        for found in held:
            for where in found.values():
                if len(where) > 3:
                    n = where[2]
                    for i in range(0, len(where), 3):
                        known[where[i] % buckets] += (where[i], where[i + 1], where[i + 1] + n)
        for bucket, found in enumerate(held):
            if not found and not known[bucket]:
                continue
            once = [where for where in found.values() if len(where) == 3]
            rows.append(
                (
                    bucket,
                    press.compress(b"\n".join(found)),
                    press.compress(np.array([len(where) > 3 for where in found.values()], dtype=bool).tobytes()),
                    np.array([where[0] for where in once], dtype=np.int64).tobytes(),
                    press.compress(np.array([where[1] for where in once], dtype=np.int32).tobytes()),
                    press.compress(np.array(known[bucket], dtype=np.int64).tobytes()),
                )
            )
            found.clear()
        if rows:
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 5), strict=True)],
                names=["bucket", "strings", "settled", "keys", "places", "spans"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = [{} for _ in range(buckets)]
        weight = 0
        for batch, texts in portions(batches, "text", 1 << 20):
            words = Words(texts)
            at, n, low = _runs(words, window, frequent.value)
            if not len(at):
                continue
            text, starts, ends = words.normal()
            owner = words.text_of_word()[at]
            keys = column(batch, "key").to_numpy(zero_copy_only=False)[owner].tolist()
            places = (at - words.first[owner]).tolist()
            where = (mix(low) % U64(buckets)).astype(np.int64).tolist()
            sizes = (n + window - 1).tolist()
            for bucket, key, place, size, a, b in zip(where, keys, places, sizes, starts[at].tolist(), ends[at + n + window - 2].tolist(), strict=True):
                found, string = held[bucket], text[a:b]
                have = found.get(string)
                if have is None:
                    found[string] = [key, place, size]
                    weight += b - a + 150
                else:
                    have += (key, place, size)
                    weight += 100
            if weight > _BLOCK_BYTES:
                yield from flush(held)
                weight = 0
        yield from flush(held)

    return run


def _same(text: bytes, starts: np.ndarray, ends: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.fromiter(
        (text[a:b] == text[c:d] for a, b, c, d in zip(starts[one].tolist(), ends[one].tolist(), starts[other].tolist(), ends[other].tolist(), strict=True)),
        dtype=bool,
        count=len(one),
    )


def _answer(window: int):
    """One bucket: sort its windows, mark those that occur again, answer with word spans."""

    def run(table: pa.Table) -> pa.Table:
        undo = zstandard.ZstdDecompressor()
        strings, settled, keys, places, spans = [], [], [], [], []
        for s, m, k, p, x in zip(*(table.column(c).to_pylist() for c in ("strings", "settled", "keys", "places", "spans")), strict=True):
            settled.append(np.frombuffer(undo.decompress(m), dtype=bool))
            if len(settled[-1]):
                strings += undo.decompress(s).split(b"\n")
            keys.append(np.frombuffer(k, dtype=np.int64))
            places.append(np.frombuffer(undo.decompress(p), dtype=np.int32))
            spans.append(np.frombuffer(undo.decompress(x), dtype=np.int64))
        settled, keys, places = np.concatenate(settled), np.concatenate(keys), np.concatenate(places)
        spans = np.concatenate(spans).reshape(-1, 3)
        words = Words(strings)
        del strings
        at = np.flatnonzero(words.left() >= window)
        hashes = windows_hash(words.hashes, window)[at]
        owner = words.text_of_word()[at]
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        equal = np.flatnonzero(ranked[1:] == ranked[:-1])
        repeated = settled[owner]
        if len(equal):
            # Equal hashes are compared as words; a neighbour that differs is put among its like.
            text, starts, ends = words.normal()
            ends = ends[at + window - 1]
            starts = starts[at]
            one, other = order[equal], order[equal + 1]
            same = _same(text, starts, ends, one, other)
            repeated[one[same]] = repeated[other[same]] = True
            for h in np.unique(ranked[equal[~same]]):
                like: dict[bytes, list[int]] = {}
                for i in order[np.searchsorted(ranked, h) : np.searchsorted(ranked, h, "right")].tolist():
                    like.setdefault(text[starts[i] : ends[i]], []).append(i)
                for group in like.values():
                    repeated[group] |= len(group) > 1
        # Spans of words within each string: runs of repeated windows.
        hits = np.flatnonzero(repeated)
        new, last = np.ones(len(hits), dtype=bool), np.ones(len(hits), dtype=bool)
        if len(hits):
            new[1:] = (hits[1:] != hits[:-1] + 1) | (owner[hits[1:]] != owner[hits[:-1]])
            last[:-1] = new[1:]
        string = owner[hits[new]]
        begin = at[hits[new]] - words.first[string]
        end = at[hits[last]] - words.first[string] + window
        # Spans of settled strings were known to their block.
        open_ = ~settled[string]
        string, begin, end = string[open_], begin[open_], end[open_]
        place = np.cumsum(~settled)[string] - 1
        return pa.table(
            {
                "key": pa.array(np.concatenate([keys[place], spans[:, 0]])),
                "begin": pa.array(np.concatenate([places[place] + begin, spans[:, 1]]).astype(np.int32)),
                "end": pa.array(np.concatenate([places[place] + end, spans[:, 2]]).astype(np.int32)),
            }
        )

    return run


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """Word spans [begin, end) covered by windows that occur again: (key, begin, end).

    ``docs`` has ``key`` (long) and ``text``. Spans of one document may touch or overlap.
    """
    if window < RUN:
        raise ValueError(f"a window has at least {RUN} words")
    spark = docs.sparkSession
    buckets = 4 * parts(spark, docs, 16 << 20)
    frequent = spark.sparkContext.broadcast(_frequent(docs, window))
    packed = docs.select("key", "text").mapInArrow(_pack(window, buckets, frequent), _PACKED)
    return packed.groupBy("bucket").applyInArrow(_answer(window), "key long, begin int, end int")


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in portions(batches, "text"):
        words = Words(texts)
        counts = words.counts()
        begins, ends = column(batch, "begins"), column(batch, "ends")
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        sizes = np.diff(begins.offsets.to_numpy())
        base = np.repeat(words.first[:-1], sizes)
        np.add.at(gone, base + begins.flatten().to_numpy(zero_copy_only=False), 1)
        np.add.at(gone, base + ends.flatten().to_numpy(zero_copy_only=False), -1)
        gone = np.cumsum(gone)[:-1] > 0
        text, starts, stops = words.normal()
        kept, removed = [], []
        totals = np.concatenate([[0], np.cumsum(gone)])
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            n = int(totals[b] - totals[a])
            removed.append(n)
            if not n:
                kept.append(text[starts[a] : stops[b - 1]] if b > a else b"")
            else:
                left = (np.flatnonzero(~gone[a:b]) + a).tolist()
                kept.append(b" ".join([text[starts[i] : stops[i]] for i in left]))
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("text", "begins", "ends")]
        names = [name for name in batch.schema.names if name not in ("text", "begins", "ends")]
        yield pa.record_batch(
            [
                *rest,
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ],
            names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 35) -> DataFrame:
    """Documents without the words that repeated windows cover.

    Returns (id, n_words, n_removed, kept_text, kept_sha256), one row per input row. Words keep
    their spelling and case and are joined by one space. Windows are judged on the input, so all
    copies of a passage go, the first one too. A NULL or empty text has 0 words and the empty
    kept text. Texts below ``window`` words never lose anything. Repeated rows repeat each
    other; equal rows get equal results. A NULL id is kept. Other columns are ignored.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    # Rows are known by id and text, so that a repeated id does no harm.
    docs = docs.withColumn("key", F.xxhash64("id", "text"))
    # A long text with few repeats has few spans: merged ones of a bucket, at most one per super-k-mer.
    spans = (
        repeated_spans(docs, window)
        .groupBy("key")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
        .select("key", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))
    )
    none = F.array().cast("array<int>")
    joined = docs.join(spans, "key", "left").select("id", "text", F.coalesce("begins", none).alias("begins"), F.coalesce("ends", none).alias("ends"))
    kind = dict(docs.dtypes)["id"]
    out = joined.mapInArrow(_drop, f"id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string")
    return out.withColumnRenamed("id", id_column)
