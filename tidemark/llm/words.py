"""Words, shingles and windows of many texts at once, as numpy arrays.

Helpers for code that runs inside Arrow map tasks. A word is a maximal run of bytes other than
space and 0x09-0x0D (UTF-8, so other characters always belong to words). All hashes are 64-bit
and fixed: they depend on bytes alone, never on the process, the partition or the run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.workers import worker_cache

U64 = np.uint64
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(_SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multipliers of polynomial hashes; any odd 64-bit number serves.
_BYTE_P, _WORD_P = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    kept = worker_cache("powers")
    have = kept.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        up, down = np.full(n, base, dtype=U64), np.full(n, pow(base, -1, 1 << 64), dtype=U64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= 1 << 22:  # larger ones serve single giant texts and are not kept
            kept[base] = have
    return have[0][:n], have[1][:n]


def _spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, step: int = 1 << 19) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, mixed with its length.

    Spans ascend and don't overlap. About ``step`` values are held as 64-bit numbers at a time.
    """
    out = np.empty(len(starts), dtype=U64)
    done = 0
    while done < len(starts):
        upto = max(done + 1, int(np.searchsorted(ends, starts[done] + step, "right")))
        begin, end = int(starts[done]), int(ends[upto - 1])
        up, down = _powers(base, end - begin + 1)
        sums = np.zeros(end - begin + 1, dtype=U64)
        np.cumsum((values[begin:end].astype(U64) + U64(1)) * up[: end - begin], out=sums[1:])
        first, last = starts[done:upto] - begin, ends[done:upto] - begin
        out[done:upto] = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U64) * U64(0xA24BAED4963EE407))
        done = upto
    return out


class Words:
    """Words of a list of texts.

    ``text``: the bytes of all texts one after the other, lower-cased (A-Z) if asked for.
    ``starts``, ``ends``: byte span of each word. ``hashes``: 64-bit hash of each word.
    ``first``: index of the first word of each text, with the total at the end.
    """

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        joined = b"\n".join(t or b"" for t in texts)
        self.text = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.text = _LOWER[self.text]
        is_word = np.zeros(len(self.text) + 2, dtype=bool)
        is_word[1:-1] = _IS_WORD[self.text]
        turns = np.flatnonzero(is_word[1:] != is_word[:-1])
        self.starts, self.ends = turns[0::2], turns[1::2]
        sizes = np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.starts, begins)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = _spans_hash(self.text, self.starts, self.ends, _BYTE_P)
        return self._hashes

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def left(self) -> np.ndarray:
        """For each word, how many words its text still has from there on."""
        return np.repeat(self.first[1:], self.counts()) - np.arange(len(self))

    def normal(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by single spaces, with the byte spans of the words there."""
        keep = _IS_WORD[self.text]
        sizes = self.ends - self.starts
        ends = np.cumsum(sizes + 1) - 1
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, dtype=np.uint8)
        place = np.ones(len(out), dtype=bool)
        place[ends] = False
        out[place] = self.text[keep]
        return out.tobytes(), ends - sizes, ends


def runs_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes (length: len - n + 1, or none)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U64)
    out = np.zeros(len(hashes) - n + 1, dtype=U64)
    factor = _WORD_P
    for i in range(n):
        out += hashes[i : len(hashes) - n + 1 + i] * U64(factor)
        factor = factor * _WORD_P % (1 << 64)
    return mix(out)


def windows_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Like runs_hash in time that doesn't depend on n."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U64)
    starts = np.arange(len(hashes) - n + 1)
    up, down = _powers(_WORD_P, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=U64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[starts + n] - sums[starts]) * down[starts])


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text as (hashes sorted within each text, bounds).

    A text with fewer words has its whole word sequence as the one shingle; one without words
    has none. bounds[i]:bounds[i + 1] is the slice of text i.
    """
    counts = words.counts()
    first = words.first[:-1]
    full = runs_hash(words.hashes, n)
    valid = np.flatnonzero(words.left() >= n)
    owner = words.text_of_word()[valid]
    values = full[valid]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        tails = [U64(0)] * len(short)
        for i, t in enumerate(short):
            tails[i] = runs_hash(words.hashes[first[t] : first[t] + counts[t]], int(counts[t]))[0] ^ U64(counts[t])
        values, owner = np.concatenate([values, np.array(tails, dtype=U64)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(counts) + 1))
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - begin > 1:
            values[begin:end].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def portions(batches: Iterable[pa.RecordBatch], column: str, size: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with at most ``size`` bytes of text each (a longer text stands alone), and their texts."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
        begin, held = 0, 0
        for i, text in enumerate(texts):
            n = len(text or b"")
            if held and held + n > size:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, held = i, 0
            held += n + 1
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def text_slices(texts: pa.Array, size: int = 2 << 20) -> Iterator[slice]:
    """Slices of about ``size`` bytes of text; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    begin = 0
    while begin < len(ends):
        base = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + size, "right")))
        yield slice(begin, end)
        begin = end


def gathered(values: list[bytes], places: pa.Array, offsets: pa.Array) -> list[bytes]:
    """For each list of places (by offsets) the values at these places, one after the other."""
    if not len(places):
        return [b""] * (len(offsets) - 1)
    joined = pa.array(values, pa.large_binary()).take(places)
    _, ends, data = joined.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data, bounds = memoryview(data if data is not None else b""), ends[offsets.to_numpy()].tolist()
    return [bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
