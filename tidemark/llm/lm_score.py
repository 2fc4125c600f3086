"""Language-model scores of texts: context-tree weighting over bytes, and a smoothed word model as base.

Both learn from every document that is not held out. Jobs:

1. Words: blocks send their distinct words with training counts by hash; each bucket sums them. The most
   frequent words (a bounded list) go to every task; other words of a document are asked for in their
   bucket, which answers with sums per document. So a word that all documents share is never
   gathered in one place.
2. Byte runs: blocks send distinct runs of DEPTH + 1 bytes with training counts, by context; each bucket
   sums them and computes its part of the tree; the few nodes above are put together from bucket
   sums; then each bucket gives every run its probability.
3. Scores: run probabilities travel to the tasks in blocks of at most ``BLOCK_RUNS``; more runs take
   more passes over the documents and add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import context_tree as tree
from tidemark.llm.storage import parts, stored
from tidemark.llm.words import U64, Words, column, mix, portions

FREQUENT = 50_000  # words whose counts every task has
BLOCK_RUNS = 3_000_000
END = U64(0x8F2A6C11D03B97E5)  # the end of a text, as a word
ALPHA = 0.1
_BLOCK_BYTES = 12 << 20


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with one end each, and the index of the text of each."""
    words = Words(texts, lower=True)
    counts = words.counts()
    out = np.full(len(words) + len(counts), END, dtype=U64)
    owner = np.repeat(np.arange(len(counts)), counts + 1)
    place = np.ones(len(out), dtype=bool)
    place[np.cumsum(counts + 1) - 1] = False
    out[place] = words.hashes
    return out, owner


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Lists of (columns, texts) that make up a block of about _BLOCK_BYTES."""
    held, size = [], 0
    for batch, texts in portions(batches, "text"):
        held.append(([column(batch, n).to_numpy(zero_copy_only=False) for n in names], texts))
        size += sum(len(t or b"") for t in texts)
        if size > _BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _bucket_slices(hashes: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([b * (1 << 64) // buckets for b in range(buckets)], dtype=U64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _open(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def _rows(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, types, strict=True)], names=[n for n, _ in types])


_COUNTS = [("bucket", pa.int32()), ("names", pa.binary()), ("counts", pa.binary())]


def _count_words(buckets: int):
    """Map task: distinct words of training texts with counts, by range of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(batches, ["held"]):
            found = []
            for (is_held,), texts in held:
                values, _ = _tokens([t for t, h in zip(texts, is_held, strict=True) if not h])
                found.append(np.unique(values, return_counts=True))
            names, at = np.unique(np.concatenate([n for n, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in found]), minlength=len(names)).astype(np.int64)
            edges = _bucket_slices(names, buckets)
            rows = [(b, _press(names[x:y]), _press(counts[x:y])) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
            if rows:
                yield _rows(rows, _COUNTS)

    return run


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    names = np.concatenate([_open(b, U64) for b in table.column("names").to_pylist()])
    counts = np.concatenate([_open(b, np.int64) for b in table.column("counts").to_pylist()])
    names, at = np.unique(names, return_inverse=True)
    return names, np.bincount(at, weights=counts, minlength=len(names)).astype(np.int64)


def _sum_words(table: pa.Table) -> pa.Table:
    """One bucket of the vocabulary, with its totals and its most frequent words."""
    names, counts = _summed(table)
    best = np.sort(np.argsort(-counts, kind="stable")[:FREQUENT])
    best = best[counts[best] > 1]
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
            "names": pa.array([_press(names)], pa.binary()),
            "counts": pa.array([_press(counts)], pa.binary()),
            "total": pa.array([int(counts.sum())], pa.int64()),
            "distinct": pa.array([len(names)], pa.int64()),
            "best": pa.array([names[best].astype(np.int64)], pa.list_(pa.int64())),
            "best_counts": pa.array([counts[best]], pa.list_(pa.int64())),
        }
    )


_ASK = [("bucket", pa.int32()), ("names", pa.binary()), ("counts", pa.binary()), ("pairs", pa.binary()), ("docs", pa.binary()), ("times", pa.binary()), ("keys", pa.binary()), ("own", pa.binary())]


def _ask(buckets: int, frequent):
    """Map task: other words of each text by bucket; what the frequent words give goes along by key.

    Per bucket: distinct words (names), number of texts with each (pairs), those texts (docs, into
    keys) and how often each has it (times). ``own``: keys, sums, known tokens and tokens of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_names, known_logs = frequent.value
        for held in _blocks(batches, ["key"]):
            values, owner, keys, base = [], [], [], 0
            sums, known, total = [], [], []
            for (key,), texts in held:
                found, who = _tokens(texts)
                n = len(texts)
                at = np.minimum(np.searchsorted(known_names, found), len(known_names) - 1)
                hit = known_names[at] == found if len(known_names) else np.zeros(len(found), dtype=bool)
                sums.append(np.bincount(who[hit], weights=known_logs[at[hit]], minlength=n))
                known.append(np.bincount(who[hit], minlength=n))
                total.append(np.bincount(who, minlength=n))
                values.append(found[~hit])
                owner.append(who[~hit] + base)
                keys.append(key)
                base += n
            values, owner, keys = np.concatenate(values), np.concatenate(owner), np.concatenate(keys)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            new = np.ones(len(values), dtype=bool)
            new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(values)))
            values, owner = values[heads], owner[heads]
            own = np.stack([keys, np.concatenate(sums).view(np.int64), np.concatenate(known), np.concatenate(total)]).astype(np.int64)
            edges = _bucket_slices(values, buckets)
            where = (keys.astype(U64) % U64(buckets)).astype(np.int64)
            rows = []
            for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                mine = own[:, where == b]
                if y == x and not mine.shape[1]:
                    continue
                names, pairs = np.unique(values[x:y], return_counts=True)
                docs, at = np.unique(owner[x:y], return_inverse=True)
                few = np.int16 if len(docs) < 32768 else np.int32
                rows.append((b, _press(names), None, _press(pairs.astype(np.int32)), _press(at.astype(few)), _press(times[x:y].astype(np.int32)), _press(keys[docs]), _press(mine)))
            if rows:
                yield _rows(rows, _ASK)

    return run


_PACKED = ("keys", "parts", "known", "tokens")


def _answer(shares: int):
    """One bucket: sums per text, as packed lists by share of the keys."""

    def run(table: pa.Table) -> pa.Table:
        cols = _sums(table)
        share = (cols[0].astype(U64) % U64(shares)).astype(np.int64)
        rows = [(int(k), *(c[share == k].tobytes() for c in cols)) for k in np.unique(share)]
        found = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table({n: pa.array(c, pa.int32() if n == "share" else pa.binary()) for n, c in zip(("share", *_PACKED), found, strict=True)})

    return run


def _total(table: pa.Table) -> pa.Table:
    """One share of the keys: sums over all buckets. Equal rows count once."""
    keys, parts, known, tokens = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=np.float64 if c == "parts" else np.int64) for c in _PACKED)
    keys, at = np.unique(keys, return_inverse=True)
    # A text's own row, which alone has its tokens, comes once per equal row.
    rows = np.bincount(at, weights=tokens > 0)
    known, tokens = (np.rint(np.bincount(at, weights=x) / rows).astype(np.int64) for x in (known, tokens))
    return pa.table({"key": pa.array(keys), "part": pa.array(np.bincount(at, weights=parts) / rows), "n_known": pa.array(known), "n_tokens": pa.array(tokens)})


def _sums(table: pa.Table) -> list[np.ndarray]:
    """The bucket's vocabulary meets the words asked for: keys, sums, known tokens, tokens of texts."""
    names, counts = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    asked = []
    for row in table.to_pylist():
        if row["counts"] is not None:
            names, counts = _open(row["names"], U64), _open(row["counts"], np.int64)
        else:
            asked.append(row)
    logs = np.log10(counts + ALPHA)
    out = [[], [], [], []]
    for row in asked:
        wanted, pairs = _open(row["names"], U64), _open(row["pairs"], np.int32)
        keys = _open(row["keys"], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(row["docs"])
        docs = np.frombuffer(raw, dtype=np.int16 if len(keys) < 32768 else np.int32)
        times = _open(row["times"], np.int32)
        if len(wanted) and len(names):
            at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
            hit = np.repeat(names[at] == wanted, pairs)
            value = np.repeat(logs[at], pairs)[hit] * times[hit]
            sums = np.bincount(docs[hit], weights=value, minlength=len(keys))
            known = np.bincount(docs[hit], weights=times[hit], minlength=len(keys)).astype(np.int64)
            some = known > 0
            for o, x in zip(out, (keys[some], sums[some], known[some], np.zeros(int(some.sum()), dtype=np.int64)), strict=True):
                o.append(x)
        own = _open(row["own"], np.int64).reshape(4, -1)
        for o, x in zip(out, (own[0], own[1].view(np.float64), own[2], own[3]), strict=True):
            o.append(x)
    kinds = (np.int64, np.float64, np.int64, np.int64)
    return [np.concatenate(o) if o else np.zeros(0, dtype=k) for o, k in zip(out, kinds, strict=True)]


def word_scores(docs: DataFrame) -> tuple[DataFrame, int]:
    """(key, n_tokens, n_known, base_score) of texts (key, held, text), and the number of training tokens."""
    spark = docs.sparkSession
    buckets = parts(spark, docs, 16 << 20)
    counted = docs.select("held", "text").mapInArrow(_count_words(buckets), "bucket int, names binary, counts binary")
    schema = "bucket int, names binary, counts binary, total long, distinct long, best array<long>, best_counts array<long>"
    words = stored(counted.groupBy("bucket").applyInArrow(_sum_words, schema), "words")
    n, v = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    best = words.select(F.explode(F.arrays_zip("best", "best_counts")).alias("w")).select("w.*").orderBy(F.desc("best_counts"), "best").limit(FREQUENT).collect()
    names = np.array([r["best"] for r in best], dtype=np.int64).astype(U64)
    logs = np.log10(np.array([r["best_counts"] for r in best], dtype=np.float64) + ALPHA)
    order = np.argsort(names)
    frequent = spark.sparkContext.broadcast((names[order], logs[order]))
    ask = docs.select("key", "text").mapInArrow(_ask(buckets, frequent), "bucket int, names binary, counts binary, pairs binary, docs binary, times binary, keys binary, own binary")
    both = ask.unionByName(words.select("bucket", "names", "counts"), allowMissingColumns=True)
    answered = both.groupBy("bucket").applyInArrow(_answer(max(1, buckets // 8)), "share int, keys binary, parts binary, known binary, tokens binary")
    sums = answered.groupBy("share").applyInArrow(_total, "key long, part double, n_known long, n_tokens long")
    floor = float(np.log10(ALPHA))
    whole = float(np.log10(n + ALPHA * (v + 1)))
    base = F.col("part") + (F.col("n_tokens") - F.col("n_known")) * floor - F.col("n_tokens") * whole
    return sums.select("key", "n_tokens", "n_known", base.alias("base_score")), n


def _sequence(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Packed byte runs of all texts, one for each byte of the words joined by spaces and for the end,
    and where each text's begin. A text starts after DEPTH line feeds; its end is one."""
    words = Words(texts, lower=True)
    joined, starts, ends = words.normal()
    first = words.first
    pieces, sizes = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        piece = joined[starts[a] : ends[b - 1]] if b > a else b""
        pieces.append(piece)
        sizes.append(len(piece) + 1)
    pad = b"\n" * tree.DEPTH
    data = np.frombuffer(pad + (b"\n" + pad).join(pieces) + b"\n", dtype=np.uint8).astype(U64)
    runs = tree.runs(data)
    sizes = np.array(sizes)
    begins = np.cumsum(sizes + tree.DEPTH) - sizes - tree.DEPTH
    keep = np.zeros(len(runs) + 1, dtype=np.int8)
    np.add.at(keep, begins, 1)
    np.add.at(keep, begins + sizes, -1)
    return runs[np.cumsum(keep[:-1]) > 0], np.cumsum(sizes) - sizes


def _by_context(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix((keys >> U64(8)) & U64((1 << 8 * tree.TOP) - 1)) % U64(buckets)).astype(np.int64)


def _count_runs(buckets: int):
    """Map task: distinct byte runs with training counts, by bucket of their nearest context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(batches, ["held"]):
            found = []
            for (is_held,), texts in held:
                for flag in (False, True):
                    some = [t for t, h in zip(texts, is_held, strict=True) if bool(h) == flag]
                    if some:
                        names, counts = np.unique(_sequence(some)[0], return_counts=True)
                        found.append((names, counts * (not flag)))
            names, at = np.unique(np.concatenate([n for n, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in found]), minlength=len(names)).astype(np.int64)
            bucket = _by_context(names, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [(b, _press(names[order[x:y]]), _press(counts[order[x:y]])) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
            yield _rows(rows, _COUNTS)

    return run


def _sum_runs(table: pa.Table) -> pa.Table:
    """One bucket of the runs, and its part of the summary for the top of the tree."""
    names, counts = _summed(table)
    top = tree.summary(tree.levels(names, counts)[tree.TOP])
    lists = [pa.array([x.astype(np.int64) if i == 0 else x], pa.list_(pa.int64() if i == 0 else pa.float64())) for i, x in enumerate(top)]
    return pa.table(
        [pa.array([len(names)], pa.int64()), pa.array([_press(names)], pa.binary()), pa.array([_press(counts)], pa.binary()), *lists],
        names=["n", "names", "counts", "node", "zeros", "ones", "below"],
    )


def _weigh(top):
    """Map task: buckets of runs to their log10 probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = tree.top_levels(top.value[0].astype(U64), *top.value[1:])
        for batch in batches:
            for n, names, counts in zip(*(column(batch, c).to_pylist() for c in ("n", "names", "counts")), strict=True):
                names, counts = _open(names, U64), _open(counts, np.int64)
                value = tree.log10_probability(names, tree.levels(names, counts), upper)
                yield pa.record_batch([pa.array([n], pa.int64()), pa.array([_press(names)], pa.binary()), pa.array([_press(value)], pa.binary())], names=["n", "names", "value"])

    return run


_BITS = float(np.log2(10))


def _score(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, value = block.value
        for batch, texts in portions(batches, "text"):
            runs, begins = _sequence(texts)
            at = np.minimum(np.searchsorted(names, runs), len(names) - 1)
            found = np.where(names[at] == runs, value[at], 0.0)
            size = np.diff(np.append(begins, len(runs)))  # one run for each byte that is coded
            yield pa.record_batch([column(batch, "key"), pa.array(np.add.reduceat(found, begins)), pa.array(size, pa.int64())], names=["key", "part", "size"])

    return run


def tree_scores(docs: DataFrame, block_runs: int = BLOCK_RUNS) -> DataFrame:
    """(key, score, size) of texts (key, held, text): log10 probability by context-tree weighting, and the bytes it codes."""
    spark = docs.sparkSession
    buckets = parts(spark, docs, 64 << 20)
    counted = docs.select("held", "text").mapInArrow(_count_runs(buckets), "bucket int, names binary, counts binary")
    schema = "n long, names binary, counts binary, node array<long>, zeros array<double>, ones array<double>, below array<double>"
    runs = stored(counted.groupBy("bucket").applyInArrow(_sum_runs, schema), "runs")
    nodes = runs.select(F.explode(F.arrays_zip("node", "zeros", "ones", "below")).alias("x")).select("x.*").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
    nodes = nodes.collect()  # 256 contexts of 255 decisions at most
    if not nodes:
        return docs.select("key", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("size")).limit(0)
    cols = [np.array([r[c] for r in nodes], dtype=np.int64 if c == "node" else np.float64) for c in ("node", "zeros", "ones", "below")]
    top = spark.sparkContext.broadcast(cols)
    weighed = stored(runs.select("n", "names", "counts").mapInArrow(_weigh(top), "n long, names binary, value binary"), "weights")
    blocks = max(1, -(-weighed.agg(F.sum("n")).first()[0] // block_runs))
    weighed = weighed.withColumn("block", F.pmod(F.xxhash64("names"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        rows = weighed.filter(F.col("block") == b).select("names", "value").collect()
        if not rows:
            continue
        names = np.concatenate([_open(bytes(r["names"]), U64) for r in rows])
        value = np.concatenate([_open(bytes(r["value"]), np.float64) for r in rows])
        order = np.argsort(names)
        found.append(docs.select("key", "text").mapInArrow(_score(spark.sparkContext.broadcast((names[order], value[order]))), "key long, part double, size long"))
    sums = reduce(DataFrame.unionByName, found).groupBy("key").agg(F.sum("part").alias("part"), F.count("*").alias("rows"), F.max("size").alias("size"))
    return sums.select("key", (F.col("part") / (F.col("rows") / len(found))).alias("score"), "size")


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per document.

    Held out are documents whose crc32 of the id as text is a multiple of 10; all others teach.
    Words are lower-cased (A-Z); each text ends with an end token. ``base_score``: word frequencies
    with ALPHA added. ``score``: the tree's log10 probability of the words joined by single spaces,
    with the end. ``bits_per_byte``: its code length for each byte of them. A NULL or empty text is its end alone. A NULL id is not held out. Equal rows are
    scored alike and each teaches. Other columns are ignored. Words are known by a 64-bit hash.
    """
    held = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 10 == 0, F.lit(False))
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), held.alias("held"))
    docs = docs.withColumn("key", F.xxhash64("id", "text"))
    base, total = word_scores(docs.select("key", "held", "text"))
    trees = tree_scores(docs.select("key", "held", "text"))
    return (
        docs.select("id", "key", "held")
        .join(base, "key")
        .join(trees, "key")
        .select(F.col("id").alias(id_column), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", (-F.col("score") * _BITS / F.col("size")).alias("bits_per_byte"))
    )
