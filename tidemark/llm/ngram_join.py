"""N-gram Jaccard join: classes of documents whose sets of word shingles are similar.

Method: prefix-tree join. Sets are put in one global order, rare shingles first, and stored in a
trie per group; a search shares the overlap of common paths and drops a subtree when the tokens
left on either side can't make up the needed overlap.

Jobs, all exact:

1. Size and fingerprint of each set. Equal sets are one class; its smallest id stands for it.
2. Which sets can have a partner at all? A linked pair differs in at most a fifth of either set,
   so of the shingles below a hash threshold all but that many must occur elsewhere. Blocks send
   their distinct sampled shingles by hash range; most documents end here. A shingle that a block
   has twice is settled there, so a common one sends one entry per block.
3. The sets of the others are stored. First joins: by two minimum hashes, in groups of at most
   ``GROUP`` sets. They connect nearly all of each class, with few comparisons.
4. Then by every shingle of each set's prefix, as prefix filtering asks, but only in groups that
   still hold several classes; a group above ``GROUP`` sets is joined block by block. Groups with the
   same members are one. A bitmap of each set, an eighth of its size or less, bounds the symmetric
   difference of two sets from below; sets travel only to groups where some pair of classes
   stays within the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.storage import parts, stored
from tidemark.llm.trie import SimilarSets
from tidemark.llm.words import U64, Words, column, mix, portions, shingle_sets

GROUP = 512
# At most this many common shingles rank last; 8 bytes each are sent to every task.
MOST_COMMON = 500_000
_LAST = U64(1 << 63)
_SAMPLE = 0.4  # share of hash values that step 2 looks at
_BELOW = U64(int(_SAMPLE * 2**64))
_TOKENS_PER_BLOCK = 2_000_000


def _sizes(n_words: int, percent: int):
    """Map task: documents to (id, n, fingerprint, number of sampled shingles that must be shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in portions(batches, "text"):
            values, bounds = shingle_sets(Words(texts, lower=True), n_words)
            n = np.diff(bounds)
            sums = [np.concatenate([[U64(0)], np.cumsum(mix(values ^ U64(seed)), dtype=U64)]) for seed in (0, 0x5BD1E995)]
            one, two = ((s[bounds[1:]] - s[bounds[:-1]]).astype(np.int64) for s in sums)
            below = np.concatenate([[0], np.cumsum(values < _BELOW)])
            must = below[bounds[1:]] - below[bounds[:-1]] - (100 - percent) * n // 100
            yield pa.record_batch([column(batch, "id"), pa.array(n), pa.array(one), pa.array(two), pa.array(must)], names=["id", "n", "one", "two", "must"])

    return run


def _ask(n_words: int, buckets: int):
    """Map task: sampled shingles of a block by bucket of their hash, each at most once.

    ``tokens``: 48 bits of the hash, as differences; ``owner``: index into ``ids``, or -1 for a
    settled token; ``ids``, ``known``: documents and how many of their shingles the block settled.
    """

    def flush(values: list, owners: list, ids: list) -> Iterator[pa.RecordBatch]:
        tokens, owner, ids = np.concatenate(values) >> U64(16), np.concatenate(owners), np.array(ids, dtype=np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.ones(len(tokens), dtype=bool)
        first[1:] = tokens[1:] != tokens[:-1]
        alone = first.copy()
        alone[:-1] &= first[1:]
        known = np.bincount(owner[~alone], minlength=len(ids))
        tokens, owner = tokens[first], np.where(alone, owner, -1)[first]
        edges = np.searchsorted(tokens, (np.arange(buckets + 1) * (int(_BELOW) >> 16) // buckets).astype(U64))
        edges[-1] = len(tokens)
        press = zstandard.ZstdCompressor(level=1)
        rows = []
        for b in range(buckets):
            part, who = tokens[edges[b] : edges[b + 1]], owner[edges[b] : edges[b + 1]]
            mine = np.flatnonzero((known > 0) & (ids % buckets == b))
            if not len(part) and not len(mine):
                continue
            seen, at = np.unique(who, return_inverse=True)
            if len(seen) and seen[0] == -1:
                seen, at = seen[1:], at - 1
            step = np.diff(part, prepend=U64(0))
            rows.append(
                (
                    b,
                    press.compress(step.tobytes()) if len(step) > 1 and step[1:].max() >> U64(32) else press.compress(step[:1].tobytes() + step[1:].astype(np.uint32).tobytes()),
                    len(part),
                    press.compress(at.astype(np.int16 if len(seen) < 32768 else np.int32).tobytes()),
                    press.compress(np.diff(ids[seen], prepend=0).tobytes()),
                    press.compress(ids[mine].tobytes() + known[mine].astype(np.int64).tobytes()),
                )
            )
        kinds = (pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "tokens", "n", "owner", "ids", "known"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, owners, ids, held, have = [], [], [], 0, {}
        for batch, texts in portions(batches, "text"):
            found, bounds = shingle_sets(Words(texts, lower=True), n_words)
            sums = np.concatenate([[U64(0)], np.cumsum(mix(found), dtype=U64)])
            mark = (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()
            for i, doc in enumerate(column(batch, "id").to_pylist()):
                a, b = bounds[i], bounds[i + 1]
                b = a + np.searchsorted(found[a:b], _BELOW)
                if doc is None or a == b:
                    continue
                # Of equal sets in one block the smallest id is looked at: it stands for them.
                same = have.get((mark[i], bounds[i + 1] - a))
                if same is not None:
                    ids[same] = min(ids[same], doc)
                    continue
                have[(mark[i], bounds[i + 1] - a)] = len(ids)
                values.append(found[a:b].copy())
                owners.append(np.full(b - a, len(ids)))
                ids.append(doc)
                held += b - a
            if held > _TOKENS_PER_BLOCK:
                yield from flush(values, owners, ids)
                values, owners, ids, held, have = [], [], [], 0, {}
        if held:
            yield from flush(values, owners, ids)

    return run


def _reply(shares: int):
    """One bucket: how many shingles of each document occur elsewhere too, as packed lists by share of the ids."""

    def run(table: pa.Table) -> pa.Table:
        ids, times = _shared(table)
        share = ids % shares
        rows = [(int(k), ids[share == k].tobytes(), times[share == k].astype(np.int64).tobytes()) for k in np.unique(share)]
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("share", "ids", "times"), cols, (pa.int32(), pa.binary(), pa.binary()), strict=True)})

    return run


def _total(table: pa.Table) -> pa.Table:
    """One share of the ids: their sums over all buckets."""
    ids, times = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=np.int64) for c in ("ids", "times"))
    ids, at = np.unique(ids, return_inverse=True)
    return pa.table({"id": pa.array(ids), "shared": pa.array(np.bincount(at, weights=times).astype(np.int64))})


def _shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    undo = zstandard.ZstdDecompressor()
    tokens, owner, ids, n_ids, known = [], [], [], 0, []
    for t, n, o, i, k in zip(*(table.column(c).to_pylist() for c in ("tokens", "n", "owner", "ids", "known")), strict=True):
        raw = undo.decompress(t)
        step = np.frombuffer(raw, dtype=U64) if len(raw) == 8 * n else np.concatenate([np.frombuffer(raw[:8], dtype=U64), np.frombuffer(raw[8:], dtype=np.uint32).astype(U64)])
        tokens.append(np.cumsum(step, dtype=U64))
        docs = np.cumsum(np.frombuffer(undo.decompress(i), dtype=np.int64))
        raw = undo.decompress(o)
        who = np.frombuffer(raw, dtype=np.int16 if len(raw) == 2 * n else np.int32).astype(np.int64)
        owner.append(np.where(who < 0, -1, who + n_ids))
        ids.append(docs)
        n_ids += len(docs)
        known.append(np.frombuffer(undo.decompress(k), dtype=np.int64).reshape(2, -1))
    tokens, owner, ids, known = np.concatenate(tokens), np.concatenate(owner), np.concatenate(ids), np.concatenate(known, axis=1)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    same = tokens[1:] == tokens[:-1]
    shared = np.zeros(len(tokens), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    # A settled token makes its other entries shared; an entry next to it is the same token's.
    times = np.bincount(owner[shared & (owner >= 0)], minlength=n_ids) if n_ids else np.zeros(0, dtype=np.int64)
    some = times > 0
    return np.concatenate([ids[some], known[0]]), np.concatenate([times[some], known[1]])


def _sets(n_words: int):
    """Map task: documents to their sets, as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in portions(batches, "text"):
            values, bounds = shingle_sets(Words(texts, lower=True), n_words)
            slices = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            blobs, maps = [x.tobytes() for x in slices], [_bitmap(x) for x in slices]
            yield pa.record_batch([column(batch, "id"), pa.array(blobs, pa.binary()), pa.array(maps, pa.binary())], names=["id", "tokens", "bitmap"])

    return run


def _bitmap(tokens: np.ndarray) -> bytes:
    """Bits of the hashes, four or more to a token, up to 65,536."""
    size = min(1 << 16, max(64, 1 << int(4 * len(tokens)).bit_length()))
    bits = np.zeros(size, dtype=bool)
    bits[(tokens & U64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _near(percent: int):
    """One group of (id, component, n, bitmap): the members that may link with another class."""

    def run(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        label = table.column("component").to_numpy()
        maps = table.column("bitmap").to_pylist()
        bits = np.array([len(m) for m in maps])
        near = np.zeros(len(n), dtype=bool)
        for size in np.unique(bits):
            # Linked sets differ in size by a quarter at most: equal maps, or the double folded in half.
            mine = np.flatnonzero((bits == size) | (bits == 2 * size))
            rows = [np.frombuffer(maps[i], dtype=U64) for i in mine]
            rows = np.stack([r if len(r) * 8 == size else r[: len(r) // 2] | r[len(r) // 2 :] for r in rows])
            for i in range(len(mine) - 1):
                rest = mine[i + 1 :]
                both = n[mine[i]] + n[rest]
                apart = np.bitwise_count(rows[i] ^ rows[i + 1 :]).sum(axis=1)
                fits = (apart <= both - 2 * -(-percent * both // (100 + percent))) & (label[rest] != label[mine[i]])
                if fits.any():
                    near[mine[i]] = True
                    near[rest[fits]] = True
        return table.filter(pa.array(near)).select(["members", "id", "component"])

    return run


def _common(sets: DataFrame) -> np.ndarray:
    """The shingles that most sets hold; a bounded list, sorted by value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, times = np.unique(np.frombuffer(b"".join(column(batch, "tokens").to_pylist()), dtype=np.int64), return_counts=True)
            some = times > 1
            yield pa.record_batch([pa.array(values[some]), pa.array(times[some])], names=["token", "n"])

    top = sets.select("tokens").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter("n > 2").orderBy(F.desc("n"), "token").limit(MOST_COMMON)
    return np.sort(np.array([r["token"] for r in top.collect()], dtype=np.int64).astype(U64))


def _ordered(blob: bytes, common: np.ndarray) -> np.ndarray:
    """A set in the global order: common shingles after all others."""
    tokens = np.frombuffer(blob, dtype=U64)
    ranks = tokens & ~_LAST
    if len(common):
        ranks[common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens] |= _LAST
    ranks.sort()
    return ranks


def _keys(common, percent: int, prefix: bool):
    """Map task: sets to join keys: two minimum hashes, or every shingle of the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, blob in zip(column(batch, "id").to_pylist(), column(batch, "tokens").to_pylist(), strict=True):
                if prefix:
                    ranks = _ordered(blob, common.value)
                    mine = ranks[: (100 - percent) * len(ranks) // 100 + 1]
                else:
                    tokens = np.frombuffer(blob, dtype=U64)
                    mine = np.array([mix(tokens ^ U64(seed)).min() for seed in (0x1F123BB5, 0x9E3779B9)], dtype=U64)
                ids.append(np.full(len(mine), doc, dtype=np.int64))
                keys.append(mine.astype(np.int64))
            if ids:
                yield pa.record_batch([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["id", "join_key"])

    return run


def _join(common, percent: int):
    """One group of sets: links that connect what is similar."""

    def run(table: pa.Table) -> pa.Table:
        join = SimilarSets(percent)
        ids = table.column("id").to_pylist()
        known: dict[int, int] = {}
        a, b = [], []
        for i, (blob, label) in enumerate(zip(table.column("tokens").to_pylist(), table.column("component").to_pylist(), strict=True)):
            for other in join.add(_ordered(blob, common.value).tolist(), known.get(label)):
                a.append(ids[i])
                b.append(ids[other])
            known.setdefault(label, i)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _linked(groups: DataFrame, sets: DataFrame, keys: list[str], common, percent: int) -> DataFrame:
    """Join the sets of each group (id, component, keys)."""
    return groups.join(sets.select("id", "tokens"), "id").groupBy(*keys).applyInArrow(_join(common, percent), "a long, b long")


def similar_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n_words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) per document.

    Words are lower-cased (A-Z); a document's set holds its distinct ``n_words``-word shingles, or
    its whole word sequence when it has fewer. Documents link when 100 * intersection >=
    ``percent`` * union; component_id is the smallest id reachable by links, itself included.
    NULL, empty and blank texts have 0 shingles, link with nothing and are their own component.
    Ids are integers; rows with a repeated id share one component; a NULL id gives a NULL
    component. Other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    sized = stored(docs.mapInArrow(_sizes(n_words, percent), "id long, n long, one long, two long, must long"), "sizes")
    same = sized.filter("n > 0 and id is not null")
    # Rows of one id are one document with several texts: they share its component.
    equal = same.groupBy("n", "one", "two").agg(F.min("id").alias("first"), F.max("must").alias("must"))
    buckets = 2 * parts(spark, docs, 16 << 20)
    asked = docs.mapInArrow(_ask(n_words, buckets), "bucket int, tokens binary, n int, owner binary, ids binary, known binary")
    replies = asked.groupBy("bucket").applyInArrow(_reply(max(1, buckets // 8)), "share int, ids binary, times binary")
    shared = replies.groupBy("share").applyInArrow(_total, "id long, shared long")
    able = (
        equal.join(shared, F.col("first") == F.col("id"), "left")
        .filter(F.coalesce("shared", F.lit(0)) >= F.col("must"))
        .select(F.col("first").alias("id"))
        .distinct()
    )
    sets = stored(docs.join(able, "id", "left_semi").mapInArrow(_sets(n_words), "id long, tokens binary, bitmap binary"), "sets")
    common = spark.sparkContext.broadcast(_common(sets))

    # First joins.
    near = sets.mapInArrow(_keys(common, percent, False), "id long, join_key long")
    sizes = near.groupBy("join_key").count().filter("count > 1")
    chunk = F.pmod(F.xxhash64("id", "join_key"), F.ceil(F.col("count") / GROUP))
    groups = near.join(sizes, "join_key").select("id", F.col("id").alias("component"), "join_key", chunk.alias("chunk"))
    links = stored(_linked(groups, sets, ["join_key", "chunk"], common, percent), "links")
    label = stored(components(links), "classes")

    # Prefix joins of what several classes share.
    listed = sets.mapInArrow(_keys(common, percent, True), "id long, join_key long").join(label, "id", "left")
    listed = listed.select("id", "join_key", F.coalesce("component", "id").alias("component"))
    mixed = listed.groupBy("join_key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("count")).filter("lo < hi")
    blocks = F.ceil(F.col("count") / GROUP).cast("int")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    groups = (
        listed.join(mixed.select("join_key", blocks.alias("blocks")), "join_key")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("join_key", F.least("mine", "other").alias("row"), F.greatest("mine", "other").alias("col"))
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select("ids")
        .distinct()
        .select(F.xxhash64("ids").alias("members"), F.explode("ids").alias("id"))
        .distinct()
    )
    maps = sets.select("id", (F.length("tokens") / 8).cast("long").alias("n"), "bitmap")
    groups = groups.join(maps, "id").join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    near = groups.groupBy("members").applyInArrow(_near(percent), "members long, id long, component long")
    rest = _linked(near, sets, ["members"], common, percent)
    stars = label.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    # Rows of one id tie the classes of their texts together.
    ties = same.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").join(same, "id").join(equal, ["n", "one", "two"]).select(F.col("id").alias("a"), F.col("first").alias("b"))
    final = components(rest.unionByName(stars).unionByName(ties))
    out = (
        sized.join(equal.select("n", "one", "two", "first"), ["n", "one", "two"], "left")
        .join(final.select(F.col("id").alias("first"), "component"), "first", "left")
        .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "first", "id").alias("component_id"))
    )
    return out
