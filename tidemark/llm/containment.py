"""Benchmark decontamination: documents that hold a benchmark item, by MinHash containment search.

Method: size-partitioned MinHash. A short item inside a long document has a tiny Jaccard similarity,
so signatures of one length miss it. Documents are partitioned by the size of their shingle set, in
powers of two, and the signature grows with the class: it has ``BINS`` bins for each shingle of the
class's upper bound, each bin holding its lowest hash. The item's signature for a class uses the
class's bins. A shared shingle is the lowest of its bin on both sides with a probability of
1 / (1 + 1 / (2 * BINS)) at least; so two independent signatures miss an item with q shared
shingles with a probability below (1 / (2 * BINS + 1)) ** (2 * q): under 1e-15 from q = 8 on.
Items with fewer shingles are looked for by all their shingles, which are few.

A document whose signature meets an item's in any bin is a candidate; it is verified by exact
containment: the share of the item's distinct shingles, compared word for word, that the document holds.

The items travel to the tasks in blocks of at most ``BLOCK_SHINGLES`` shingles; a larger set takes more
passes over the documents, one per block, and finds the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, Words, column, mix, portions, shingle_sets

BINS = 4
FEW = 8
BLOCK_SHINGLES = 1_000_000
_SEEDS = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)


def _shingle_texts(text: str | bytes | None, n: int) -> set[bytes]:
    """Distinct shingles as bytes, words joined by single spaces."""
    words = Words([text.encode() if isinstance(text, str) else text], lower=True)
    joined, starts, ends = words.normal()
    count = len(words)
    if not count:
        return set()
    if count < n:
        return {joined[: ends[-1]]}
    return {joined[a:b] for a, b in zip(starts[: count - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)}


def _signature(values: np.ndarray, size_class: int) -> np.ndarray:
    """Bin minima of a set for a class, each as one number that names signature, class, bin and hash."""
    out = []
    bits = size_class + BINS.bit_length() - 1
    for k, seed in enumerate(_SEEDS):
        hashes = mix(values ^ U64(seed))
        hashes.sort()
        bins = hashes & U64((1 << bits) - 1)
        _, first = np.unique(bins, return_index=True)  # hashes ascend: the first of a bin is its lowest
        out.append(mix(hashes[first] ^ U64((size_class << 8 | k) * 0x100000001B3)))
    return np.concatenate(out)


class Items:
    """A block of benchmark items, ready for search."""

    def __init__(self, rows: list[tuple[int, str]], n_words: int):
        self.n_words = n_words
        self.shingles = {i: _shingle_texts(t, n_words) for i, t in rows}
        words = Words([t.encode() for _, t in rows], lower=True)
        values, bounds = shingle_sets(words, n_words)
        self.sets = {i: values[a:b] for (i, _), a, b in zip(rows, bounds[:-1], bounds[1:], strict=True)}
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        few = [(i, s) for i, s in self.sets.items() if len(s) < FEW]
        self.few = np.unique(np.concatenate([s for _, s in few])) if few else np.zeros(0, dtype=U64)
        self.few_items = defaultdict(list)
        for i, s in few:
            for h in s.tolist():
                self.few_items[h].append(i)

    def table(self, size_class: int) -> tuple[np.ndarray, np.ndarray]:
        """Signature values of all items for a class, sorted, with their items."""
        if size_class not in self.tables:
            parts = [(i, _signature(s, size_class)) for i, s in self.sets.items() if len(s) >= FEW]
            keys = np.concatenate([s for _, s in parts]) if parts else np.zeros(0, dtype=U64)
            owner = np.concatenate([np.full(len(s), i, dtype=np.int64) for i, s in parts]) if parts else np.zeros(0, dtype=np.int64)
            order = np.argsort(keys, kind="stable")
            self.tables[size_class] = keys[order], owner[order]
        return self.tables[size_class]

    def candidates(self, values: np.ndarray) -> set[int]:
        found: set[int] = set()
        if not len(values):
            return found
        size_class = int(len(values) - 1).bit_length()
        keys, owner = self.table(size_class)
        if len(keys):
            mine = _signature(values, size_class)
            low = np.searchsorted(keys, mine)
            hit = keys[np.minimum(low, len(keys) - 1)] == mine
            for a, b in zip(low[hit].tolist(), np.searchsorted(keys, mine[hit], "right").tolist(), strict=True):
                found.update(owner[a:b].tolist())
        if len(self.few):
            at = np.minimum(np.searchsorted(values, self.few), len(values) - 1)
            for h in self.few[values[at] == self.few].tolist():
                found.update(self.few_items[h])
        return found

    def verified(self, text: bytes, found: set[int], percent: int) -> list[tuple[int, int, int]]:
        """(item, shared, size) of the candidates that the text contains."""
        if not found:
            return []
        mine = _shingle_texts(text, self.n_words)
        out = []
        for i in sorted(found):
            size = len(self.shingles[i])
            shared = len(self.shingles[i] & mine)
            if size and 100 * shared >= percent * size:
                out.append((i, shared, size))
        return out


def _search(items, n_words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(items.value, n_words)
        for batch, texts in portions(batches, "text"):
            ids = column(batch, "id")
            values, bounds = shingle_sets(Words(texts, lower=True), n_words)
            rows, found = [], []
            for n, text in enumerate(texts):
                for hit in block.verified(text or b"", block.candidates(values[bounds[n] : bounds[n + 1]]), percent):
                    rows.append(n)
                    found.append(hit)
            yield pa.record_batch(
                [ids.take(pa.array(rows, pa.int64())), *[pa.array([h[k] for h in found], pa.int64()) for k in range(3)]],
                names=["id", "item_id", "shared", "n_shingles"],
            )

    return run


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n_words: int = 5,
    percent: int = 80,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(id, item_id, shared, n_shingles): items of which a document holds ``percent`` of the distinct shingles.

    Words are lower-cased (A-Z); an item or document with fewer than ``n_words`` words is one shingle.
    NULL, empty and blank texts hold nothing and are held by nothing. Repeated document rows give
    repeated results; items that share an id count as the one with the lowest text. Item ids are
    integers. Other columns are ignored.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(docs.dtypes)["id"]
    found = [docs.mapInArrow(_search(rows, n_words, percent), f"id {kind}, item_id long, shared long, n_shingles long") for rows in _item_blocks(benchmark, block_shingles)]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("id", id_column)


def _item_blocks(benchmark: DataFrame, block_shingles: int) -> list:
    """The items as broadcast lists of (item_id, text), one per block; a block's size is bounded by its characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // (2 * block_shingles)))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    send = benchmark.sparkSession.sparkContext.broadcast
    return [send([(r["item_id"], r["text"]) for r in items.filter(block == b).collect()]) for b in range(n_blocks)]


def _clean(items, n_words: int, percent: int, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(items.value, n_words)
        for batch, texts in portions(batches, text_column):
            values, bounds = shingle_sets(Words(texts, lower=True), n_words)
            keep = [not block.verified(t or b"", block.candidates(values[bounds[i] : bounds[i + 1]]), percent) for i, t in enumerate(texts)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", n_words: int = 5, percent: int = 80, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; each row is judged by its text. No shuffle."""
    for rows in _item_blocks(benchmark, block_shingles):
        docs = docs.mapInArrow(_clean(rows, n_words, percent, text_column), docs.schema)
    return docs
