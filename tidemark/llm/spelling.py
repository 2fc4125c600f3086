"""Spelling variant grouping: words one edit apart, and the frequent form behind each.

Method: a dictionary of pairs of trie nodes. The nodes of a trie of all words and of a trie of
the reversed words are numbered, so a prefix and a suffix are two integers. A word of L letters
has the L pairs (prefix before a letter, suffix behind it) with that letter skipped and the L + 1
pairs (prefix, rest) of a place where a letter could be inserted. Words that share a skipping pair
differ by one replaced letter; a skipping and an inserting pair that are equal belong to two
words of which one has one letter more. So two joins on integer pairs give exactly the near words.

Both tries are built on sorted words: a task numbers the nodes of its range of words from the letters
that neighbours share, and one list of first and last words per range tells which nodes began in
an earlier range. Nodes that only one word has can't be in a pair of two and are left out.

A pair has at most one inserting word, and skipping words differ in one letter, so there are no
more of them than letters: groups are small for any input, and a group answers with one row per member.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import parts, stored
from tidemark.llm.words import column, portions

# Letters are A-Z, a-z and U+00C0 to U+00FF; in Latin-1 each is one byte, its code point.
_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0xC0, 0x100))
_TO_WORDS = bytes(b + 32 if 0x41 <= b < 0x5B else b if b in _LETTERS else 0x20 for b in range(256))
_BLOCK_WORDS = 300_000
_OFTEN = 16
_RANGE = 40  # bits for what a range numbers; the range stands above them


def runs_of_letters(text: str) -> list[bytes]:
    """Maximal runs of letters in lower case (A-Z only), as Latin-1. What Latin-1 lacks becomes '?'."""
    return text.encode("latin-1", "replace").translate(_TO_WORDS).split()


def _edited(word: bytes, salt: int, every: int) -> bytes:
    """The word, or without one letter where the checksum of id and word says so."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), salt)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(chars: int, every: int | None):
    def emit(found: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        if found:
            words = pa.array([w.decode("latin-1") for w in found])
            batch = pa.record_batch([words, pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            for begin in range(0, batch.num_rows, 50_000):
                yield batch.slice(begin, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch, texts in portions(batches, "text"):
            for i, text in zip(column(batch, "id").to_pylist(), texts, strict=True):
                own = Counter(runs_of_letters((text or b"").decode("utf-8", "replace")))
                salt = zlib.crc32(f"{'' if i is None else i}:".encode())
                for word, n in own.items():
                    if len(word) >= chars:
                        word = _edited(word, salt, every) if every else word
                        if len(word) >= chars:
                            found[word] += n
            if len(found) > _BLOCK_WORDS:
                # Words the task sees often stay, so they cost one row a task.
                often = Counter({w: n for w, n in found.items() if n >= _OFTEN})
                if 2 * len(often) > _BLOCK_WORDS:
                    often = Counter()
                yield from emit({w: n for w, n in found.items() if w not in often})
                found = often
        yield from emit(found)

    return run


def count_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chars: int = 6, least: int = 5, every: int | None = None
) -> DataFrame:
    """(word, n): runs of letters in lower case (A-Z) of at least ``chars`` code points and ``least`` occurrences.

    With ``every``, a run loses one letter where ``every`` divides the checksum crc32 of
    '<id>:<run>': the made-up misspellings of the test query. A NULL text has no words; a
    NULL id is written as nothing. Texts of any length are read whole, an empty table has no words.
    """
    docs = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    counted = docs.mapInArrow(_count(chars, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _shared(a: str, b: str) -> int:
    """Number of letters two words share from the start."""
    if b.startswith(a) or a.startswith(b):
        return min(len(a), len(b))
    return next(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of sorted words: (part, place, word, n, nodes) with the nodes of prefixes 0, 1, ...

    The trie's root is 0. A new node gets the next number of the range. ``nodes`` ends behind the
    longest prefix shared with a neighbour; the first and last word of the range keep all.
    """
    part = TaskContext.get().partitionId()
    base, made, place = part << _RANGE, 0, 0
    path: list[int] = [0]
    last, held = None, None  # the word before, and its row with the letters it shared with its own predecessor
    rows: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        word, n, at, nodes = zip(*rows, strict=True)
        out = [pa.array([part] * len(rows), pa.int32()), pa.array(at, pa.int64()), pa.array(word), pa.array(n, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))]
        rows.clear()
        return pa.record_batch(out, names=["part", "place", "word", "n", "nodes"])

    for batch in batches:
        for word, n in zip(column(batch, "word").to_pylist(), column(batch, "n").to_pylist(), strict=True):
            same = 0 if last is None else _shared(last, word)
            if held is not None:
                before, row = held
                rows.append((*row[:3], row[3][: max(before, same) + 1]))
            new = len(word) - same
            path = path[: same + 1] + list(range(base + made + 1, base + made + new + 1))
            made += new
            held = (len(word) if last is None else same), (word, n, base + place, path)
            place += 1
            last = word
            if len(rows) >= 20_000:
                yield batch_of()
    if held is not None:
        rows.append(held[1])
        yield batch_of()


_NODES = "part int, place long, word string, n long, nodes array<long>"


def _carry(ends: list) -> dict[int, tuple[str, list[int]]]:
    """Per range: its first word and the nodes that word shares with earlier ranges."""
    out, before, path = {}, None, [0]
    for part, first, last, nodes in ends:
        common = path[: _shared(before, first) + 1] if before is not None else [0]
        out[part] = first, common
        # The last word's path, with the nodes that began earlier in their place.
        keep = min(len(common), _shared(first, last) + 1)
        before, path = last, common[:keep] + nodes[keep:]
    return out


def trie_nodes(words: DataFrame) -> DataFrame:
    """(place, word, n, nodes): words numbered in code-point order, with numbered trie nodes of their prefixes.

    ``words`` has distinct ``word`` and ``n``. Prefixes that no other word has may be missing at
    the end of ``nodes``.
    """
    n_parts = parts(words.sparkSession, words, 8 << 20)
    ranged = words.select("word", "n").repartitionByRange(n_parts, "word").sortWithinPartitions("word")
    nodes = stored(ranged.mapInArrow(_number, _NODES), "trie")
    # One row per range: its first and last word and the path of the last one.
    ends = nodes.groupBy("part").agg(F.min("word").alias("first"), F.max_by(F.struct("word", "nodes"), "place").alias("last"))
    carry = _carry([(r["part"], r["first"], r["last"]["word"], r["last"]["nodes"]) for r in ends.orderBy("part").collect()])
    carry = words.sparkSession.sparkContext.broadcast(carry)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, word, own in zip(*(column(batch, c).to_pylist() for c in ("part", "word", "nodes")), strict=True):
                first, common = carry.value[part]
                keep = min(len(common), _shared(first, word) + 1, len(own))
                out.append(common[:keep] + own[keep:])
            yield pa.record_batch([column(batch, c) for c in ("place", "word", "n")] + [pa.array(out, pa.list_(pa.int64()))], names=["place", "word", "n", "nodes"])

    return nodes.mapInArrow(mend, "place long, word string, n long, nodes array<long>")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node pairs (prefix, suffix, kind, id, n) of each word. Kinds: 0 inserts, 1 skips, 2 skips and may match an insert.

    Of a run of equal letters only the last is skipped against inserts, so that a near word is met once.
    """
    for batch in batches:
        rows: list[tuple] = []
        for i, word, n, ahead, behind in zip(*(column(batch, c).to_pylist() for c in ("place", "word", "n", "nodes", "back")), strict=True):
            size = len(word)
            # Prefixes up to len(ahead) - 1 letters and suffixes up to len(behind) - 1 letters are shared.
            for at in range(max(0, size - len(behind)), min(size, len(ahead) - 1) + 1):
                rest = size - at
                if rest < len(behind):
                    rows.append((ahead[at], behind[rest], 0, i, n))
                if at < size:
                    rows.append((ahead[at], behind[rest - 1], 1 if rest > 1 and word[at] == word[at + 1] else 2, i, n))
            if len(rows) >= 50_000:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["p", "s", "kind", "id", "n"])
                rows.clear()
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["p", "s", "kind", "id", "n"])


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) of all words in code-point order, and (id, n_near, best) of those with near words.

    ``best`` is (minus n, id) of the near word with the largest n, the first in code-point order
    of equals.
    """
    words = stored(words.groupBy("word").agg(F.sum("n").alias("n")).filter("word is not null"), "words")
    ahead = trie_nodes(words)
    behind = trie_nodes(words.select(F.reverse("word").alias("word"), "n"))
    both = stored(ahead.join(behind.select(F.reverse("word").alias("word"), F.col("nodes").alias("back")), "word"), "nodes")
    pairs = both.select("place", "word", "n", "nodes", "back").mapInArrow(_pairs, "p long, s long, kind long, id long, n long")
    member = F.struct((-F.col("n")).alias("m"), F.col("id"))
    groups = pairs.groupBy("p", "s").agg(
        F.max(F.when(F.col("kind") == 0, member)).alias("whole"),
        # Words that differ in one letter: no more than letters.
        F.sort_array(F.collect_list(F.when(F.col("kind") > 0, F.struct((-F.col("n")).alias("m"), "id", "kind")))).alias("skip"),
    )
    groups = groups.filter((F.size("skip") > 1) | ((F.size("skip") > 0) & F.col("whole").isNotNull()))
    as_member = lambda x: F.struct(x["m"].alias("m"), x["id"].alias("id"))
    meets = lambda x: (x["kind"] == 2) & F.col("whole").isNotNull()
    nobody = F.lit(None).cast("struct<m:bigint,id:bigint>")
    others = F.transform(
        "skip",
        lambda x: F.struct(
            x["id"].alias("id"),
            (F.size("skip") - 1 + F.when(meets(x), 1).otherwise(0)).cast("long").alias("n_near"),
            # The first of the list, or the second for the first itself; least() passes over NULLs.
            F.least(
                F.when(F.size("skip") > 1, as_member(F.when(F.get("skip", F.lit(0))["id"] == x["id"], F.get("skip", F.lit(1))).otherwise(F.get("skip", F.lit(0))))),
                F.when(meets(x), F.col("whole")),
            ).alias("best"),
        ),
    )
    open_ = F.filter("skip", lambda x: meets(x))
    inserted = F.array(
        F.struct(
            F.col("whole")["id"].alias("id"),
            F.size(open_).cast("long").alias("n_near"),
            F.when(F.size(open_) > 0, as_member(F.get(open_, F.lit(0)))).otherwise(nobody).alias("best"),
        )
    )
    answers = groups.select(F.inline(F.concat(others, inserted))).filter("id is not null and best is not null")
    near = answers.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return both.select(F.col("place").alias("id"), "word", "n"), near


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(id, root): ids with the end of their chain of forms, of at most ``steps`` links, by doubling."""
    roots = stored(forms, "forms")
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        next_ = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(next_, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
    return roots


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``words`` (word, n).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point;
    ``n_near`` counts them. ``form`` is the near word of largest n, the first in code-point order of
    equals, if its n is at least ``ratio`` (2 or more) times the word's; else NULL. ``root`` ends
    the chain of forms, or is the word itself. Rows that repeat a word add up; NULL words are left
    out; counts are positive. Words of any length and empty tables are allowed; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("chains of forms end only with a ratio of 2 or more")
    words, near = near_words(words)
    found = words.join(near, "id", "left")
    held = F.when(-F.col("best")["m"] >= ratio * F.col("n"), F.col("best"))
    found = stored(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), held["id"].alias("form"), (-held["m"]).alias("form_n")), "near")
    low, high = found.agg(F.min("n"), F.max("n")).first()
    # Each link multiplies n by ratio at least.
    steps = 0
    while low and low * ratio ** (steps + 1) <= high:
        steps += 1
    roots = _roots(found.filter("form is not null").select("id", F.col("form").alias("root")), steps)
    name = lambda key, as_: found.select(F.col("id").alias(key), F.col("word").alias(as_))
    named = roots.join(found.select("id", "form"), "id").join(name("form", "form_word"), "form").join(name("root", "root_word"), "root")
    out = found.drop("form").join(named.select("id", "form_word", "root_word"), "id", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
