"""Arrays of known lines behind a sharded minimal perfect hash.

A line is known by a 128-bit hash, as two 64-bit numbers. Each shard holds the lines of one
remainder of the first number. The perfect hash of a shard is a list of bit arrays: a line
lies at the first level where no other line that is left takes its bit, and its number is the
rank of that bit, so n lines get the numbers 0 to n - 1 and nothing but bits is stored (about 3.7 a line). At
that number stand the line's fingerprint, the count of texts that hold it, and its keeper.
Any other line gets some number too, or none; the fingerprint tells it apart.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from tidemark.llm.words import U64, mix

_LOAD = 2  # bits per line that is left, in each level
SHARD_SCHEMA = "shard int, lines long, sizes binary, bits binary, heads binary, prints binary, counts binary, keepers binary"


def _place(first: np.ndarray, second: np.ndarray, level: int, sizes) -> np.ndarray:
    return (mix(first + U64(level + 1) * second) % sizes).astype(np.int64)


def _perfect(first: np.ndarray, second: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels (multiples of 64) and their bits, for distinct lines."""
    sizes, levels = [], []
    while len(first):
        if len(sizes) > 200:
            raise ValueError("lines repeat")
        size = -(-_LOAD * len(first) // 64) * 64
        at = _place(first, second, len(sizes), U64(size))
        taken = np.bincount(at, minlength=size)
        levels.append(taken == 1)
        sizes.append(size)
        left = taken[at] > 1
        first, second = first[left], second[left]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool)


def shard_row(shard: int, first: np.ndarray, second: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> dict:
    """A shard's arrays as one row, in the order of the perfect hash."""
    sizes, bits = _perfect(first, second)
    row = {"shard": shard, "lines": len(first), "sizes": np.array(sizes, dtype=np.int64).tobytes()}
    row["bits"] = np.packbits(bits, bitorder="little").tobytes()
    alone = LineIndex([{**row, "prints": b"", "counts": b"", "keepers": b""}], shard + 1)
    order = np.empty(len(first), dtype=np.int64)
    order[alone.numbers(np.full(len(first), shard), first, second)] = np.arange(len(first))
    arrays = {"heads": first, "prints": second, "counts": counts.astype(np.int64), "keepers": keepers.astype(np.int64)}
    return row | {name: values[order].tobytes() for name, values in arrays.items()}


def row_lines(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and second number, count and keeper of the lines of a shard's row."""
    kinds = {"heads": U64, "prints": U64, "counts": np.int64, "keepers": np.int64}
    return tuple(np.frombuffer(row[name], dtype=kind) for name, kind in kinds.items())


class LineIndex:
    """Several shards at once; probed for many lines at a time, without a loop over shards."""

    def __init__(self, rows: Iterable[dict], shards: int):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards = shards
        sizes = [np.frombuffer(r["sizes"], dtype=np.int64) for r in rows]
        depth = max((len(s) for s in sizes), default=0)
        # Bits of each level of each shard held, and where they begin; shards not held have none.
        self.where = np.full(shards, -1, dtype=np.int64)
        self.where[[r["shard"] for r in rows]] = np.arange(len(rows))
        self.sizes = np.zeros((depth, len(rows)), dtype=np.int64)
        for i, s in enumerate(sizes):
            self.sizes[: len(s), i] = s
        ends = np.cumsum(self.sizes.T.ravel()).reshape(len(rows), depth).T if rows else self.sizes
        self.begins = ends - self.sizes
        self.words = np.frombuffer(b"".join(r["bits"] for r in rows), dtype=np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.prints = np.frombuffer(b"".join(r["prints"] for r in rows), dtype=np.uint64)
        self.counts = np.frombuffer(b"".join(r["counts"] for r in rows), dtype=np.int64)
        self.keepers = np.frombuffer(b"".join(r["keepers"] for r in rows), dtype=np.int64)

    def __len__(self) -> int:
        return len(self.prints)

    def numbers(self, shard: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Number of each line, or -1; a line that is not in the index may get any."""
        out = np.full(len(first), -1, dtype=np.int64)
        open_, row = np.arange(len(first)), self.where[shard]
        open_, row = open_[row >= 0], row[row >= 0]
        for level in range(len(self.sizes)):
            some = self.sizes[level][row] > 0
            open_, row = open_[some], row[some]
            if not len(open_):
                break
            bit = self.begins[level][row] + _place(first[open_], second[open_], level, self.sizes[level][row].astype(U64))
            word, within = self.words[bit >> 6], (bit & 63).astype(U64)
            hit = (word >> within) & U64(1) == 1
            below = word[hit] & ((U64(1) << within[hit]) - U64(1))
            out[open_[hit]] = self.ranks[bit[hit] >> 6] + np.bitwise_count(below)
            open_, row = open_[~hit], row[~hit]
        return out

    def probe(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Number of each line that is in the index, -1 for others."""
        numbers = self.numbers((first % U64(self.shards)).astype(np.int64), first, second)
        known = numbers >= 0
        known[known] = self.prints[numbers[known]] == second[known]
        return np.where(known, numbers, -1)
