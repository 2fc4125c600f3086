"""Context-tree weighting over bytes: model from counts of byte runs, as numpy arrays.

A byte is eight binary decisions; each decision under each context of 0 to DEPTH previous bytes is a
node with a Krichevsky-Trofimov estimate. A node's weighted probability is the even mixture of its own
estimate and the product of its children's (contexts one byte longer). All of it follows from counts,
so the order of the corpus doesn't matter and the tree splits by its nearest context bytes.

A run is packed in a number: the oldest byte highest, the coded byte lowest.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import U64

DEPTH = 4
TOP = 2  # contexts of fewer bytes than this are the top of the tree, kept in one small table


def log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def runs(data: np.ndarray) -> np.ndarray:
    """Packed run that ends at each byte from index DEPTH on."""
    out = np.zeros(len(data) - DEPTH, dtype=U64)
    for i in range(DEPTH + 1):
        out = (out << U64(8)) | data[i : i + len(out)]
    return out


def decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each run's byte, the eight prefixes (with a leading one) and bits: arrays of shape (8, n)."""
    byte = keys & U64(255)
    prefix = np.stack([(byte >> U64(8 - k)) | U64(1 << k) for k in range(8)])
    bit = np.stack([(byte >> U64(7 - k)) & U64(1) for k in range(8)])
    return prefix, bit


def _context(keys: np.ndarray, depth: int) -> np.ndarray:
    return (keys >> U64(8)) & U64((1 << 8 * depth) - 1)


class Level:
    """Nodes of one depth: names (context << 8 | prefix), counts, own and weighted probability."""

    def __init__(self, names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.names, self.zeros, self.ones = names, zeros, ones
        own = kt(zeros, ones)
        if below is None:
            self.share = np.ones(len(names))
            self.weighted = own
        else:
            self.share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
            self.weighted = np.logaddexp(own, below) - np.log(2)

    def one(self, at: np.ndarray) -> np.ndarray:
        """Estimate that the next bit is one."""
        return (self.ones[at] + 0.5) / (self.zeros[at] + self.ones[at] + 1)


def levels(keys: np.ndarray, counts: np.ndarray) -> dict[int, Level]:
    """All levels from DEPTH up to TOP of the runs of whole TOP-byte contexts."""
    prefix, bit = decisions(keys)
    out: dict[int, Level] = {}
    for depth in range(DEPTH, TOP - 1, -1):
        names, at = np.unique((_context(keys, depth)[None, :] << U64(8)) | prefix, return_inverse=True)
        at = at.reshape(-1)
        weight = np.broadcast_to(counts.astype(np.float64), bit.shape).reshape(-1)
        ones = np.bincount(at, weights=weight * bit.reshape(-1), minlength=len(names))
        zeros = np.bincount(at, weights=weight, minlength=len(names)) - ones
        below = None
        if depth < DEPTH:
            child = out[depth + 1]
            parent = ((child.names >> U64(8)) & U64((1 << 8 * depth) - 1)) << U64(8) | (child.names & U64(255))
            below = np.bincount(np.searchsorted(names, parent), weights=child.weighted, minlength=len(names))
        out[depth] = Level(names, zeros, ones, below)
    return out


def summary(level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A level's nodes summed by the context one byte shorter: names, zeros, ones, weighted."""
    short = ((level.names >> U64(8)) & U64((1 << 8 * (TOP - 1)) - 1)) << U64(8) | (level.names & U64(255))
    names, at = np.unique(short, return_inverse=True)
    return names, *(np.bincount(at, weights=x, minlength=len(names)) for x in (level.zeros, level.ones, level.weighted))


def top_levels(names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> dict[int, Level]:
    """The levels above TOP, from the summary of all of the TOP level: at most 65,535 nodes each."""
    order = np.argsort(names)
    out = {TOP - 1: Level(names[order], zeros[order], ones[order], below[order])}
    for depth in range(TOP - 2, -1, -1):
        child = out[depth + 1]
        parent = ((child.names >> U64(8)) & U64((1 << 8 * depth) - 1)) << U64(8) | (child.names & U64(255))
        mine, at = np.unique(parent, return_inverse=True)
        out[depth] = Level(mine, *(np.bincount(at, weights=x, minlength=len(mine)) for x in (child.zeros, child.ones, child.weighted)))
    return out


def log10_probability(keys: np.ndarray, below: dict[int, Level], top: dict[int, Level]) -> np.ndarray:
    """log10 of the weighted probability of each run's byte after its context. All nodes must exist."""
    prefix, bit = decisions(keys)
    one = None
    for depth in range(DEPTH, -1, -1):
        level = below[depth] if depth >= TOP else top[depth]
        at = np.searchsorted(level.names, (_context(keys, depth)[None, :] << U64(8)) | prefix)
        own = level.one(at)
        one = own if one is None else level.share[at] * own + (1 - level.share[at]) * one
    return np.log10(np.where(bit == 1, one, 1 - one)).sum(axis=0)
