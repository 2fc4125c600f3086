"""Byte-pair pieces of a SentencePiece model: segmentation of strings, whole or from a boundary state.

A SentencePiece BPE model joins, again and again, the adjacent pair whose joined piece has the best
score. Its result is the only sequence of pieces in which every two neighbours, joined and segmented
by themselves, give these two pieces back. So segmentation is a path problem: an edge from one piece
to the next is allowed (0) or not (minus infinity), each piece costs 1, and paths compose in the
max-plus algebra. That is what lets a text be cut anywhere (see sentencepiece_scan).
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.words import gathered
from tidemark.llm.workers import worker_cache

SPACE = "▁"  # stands for a space in pieces
_MOST_KEPT = 250_000
# Entries of a worker's caches, in each of two generations: they stay when the task ends.
_WORDS_KEPT, _SEGMENTS_KEPT = 100_000, 10_000
_SHORT = 48
_NEVER = float("-inf")

# A boundary state: start, end and string of the piece that reaches a cut, relative to the cut.
State = tuple[int, int, str]


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id = {model.id_to_piece(i): i for i in plain}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.bytes = [0] * 256
        for i in range(size):
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
        self.longest = max(map(len, self.id))
        inner = [p for p in self.id if SPACE in p.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces that reach across a space can't be segmented by words: {inner[:3]}")
        if model.encode("a b") and model.decode(model.encode("  a ")) != "  a ":
            raise ValueError("models that drop spaces are not supported")
        # A line feed that no piece holds parts a text as a space does, and is an id of its own.
        self.joins_lines = any("\n" in p for p in self.id)
        part = SPACE if self.joins_lines else SPACE + "\n"
        self.segment = re.compile(f"{SPACE}*[^{part}]+|{SPACE}+|\n")
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.id.items()}
        # What each id stands for; a byte for byte pieces.
        self.out = [b""] * size
        for p, i in self.id.items():
            self.out[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes):
            self.out[i] = bytes([b])
        self.pairs: dict[tuple[str, str], bool] = {}

    def split(self, segment: str) -> list[str]:
        """Pieces of a string; characters without a piece stand alone."""
        n, score = len(segment), self.score
        if n <= 1:
            return [segment] if n else []
        if n <= _SHORT:
            return self._split_short(segment)
        parts: list[str | None] = list(segment)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            s = score.get(segment[i : i + 2])
            if s is not None:
                heap.append((-s, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = parts[i]
            if left is None or (j := after[i]) >= n or len(left) + len(parts[j]) != size:
                continue  # one of the two was joined otherwise meanwhile
            joined = left + parts[j]
            parts[i], parts[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                s = score.get(joined + parts[k])
                if s is not None:
                    heapq.heappush(heap, (-s, i, size + len(parts[k])))
            h = before[i]
            if h >= 0:
                s = score.get(parts[h] + joined)
                if s is not None:
                    heapq.heappush(heap, (-s, h, size + len(parts[h])))
        return [p for p in parts if p is not None]

    def _split_short(self, segment: str) -> list[str]:
        """The same by plain search for the best pair, the leftmost of equals: faster on words."""
        get, parts = self.score.get, list(segment)
        scores = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > _NEVER:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], _NEVER)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """May these two pieces be neighbours?"""
        key = (left, right)
        have = self.pairs.get(key)
        if have is None:
            if len(self.pairs) > _MOST_KEPT:
                self.pairs.clear()
            have = self.pairs[key] = self.split(left + right) == [left, right]
        return have

    def ends_at(self, text: str, end: int, least: int):
        """(start, piece) of the pieces of text that end there and start at ``least`` or later."""
        for start in range(max(least, end - self.longest), end):
            piece = text[start:end]
            if piece in self.id or end - start == 1:
                yield start, piece

    def paths(self, text: str, begin: int, first: str | None, until: int) -> dict[int, tuple[int, str]]:
        """Last piece (start, string) of the path from ``begin`` to each end that has one.

        ``first``: the piece before ``begin``, or None at the start of a segment. There is one path
        at most to each end.
        """
        last: dict[int, tuple[int, str]] = {}
        for end in range(begin + 1, until + 1):
            for start, piece in self.ends_at(text, end, begin):
                if start == begin:
                    ok = first is None or self.fits(first, piece)
                else:
                    ok = start in last and self.fits(last[start][1], piece)
                if ok:
                    last[end] = (start, piece)
                    break
            if end - begin > 2 * self.longest and not any(e in last for e in range(end - self.longest, end + 1)):
                break  # no path leads on
        return last

    def ids(self, pieces: list[str]) -> bytes:
        """Ids as little-endian 32-bit numbers; a character without a piece gives those of its bytes."""
        packed = self.packed
        try:
            return b"".join([packed[p] for p in pieces])
        except KeyError:
            return b"".join([packed.get(p) or b"".join(self.bytes[b].to_bytes(4, "little") for b in p.encode()) for p in pieces])

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words with a space before each, from the library: a word has no space or line end inside."""
        return [array("I", ids).tobytes() for ids in self.model.encode(words, num_threads=1)]


class _Kept(dict):
    """Computed values by string. When it is full, what it holds becomes the old generation, from which
    frequent strings come back."""

    def __init__(self, compute: Callable[[str], bytes], most: int):
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        return self.put(key, self.compute(key) if value is None else value)

    def put(self, key: str, value: bytes) -> bytes:
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def normal(text: str) -> str:
    """What the model segments: a space before, spaces as the space character. Empty stays empty."""
    return (SPACE + text).replace(" ", SPACE) if text else ""


class Segments:
    """Ids of texts as little-endian 32-bit numbers, by distinct words; a worker computes each word once."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.segments = _Kept(lambda segment: pieces.ids(pieces.split(segment)), _SEGMENTS_KEPT)
        self.words = _Kept(lambda word: self._compute([word])[0], _WORDS_KEPT)
        self.line_end = pieces.ids(["\n"])

    def parts(self, text: str) -> bytes:
        """Ids of any normal text, segment by segment."""
        return b"".join(map(self.segments.__getitem__, self.pieces.segment.findall(text)))

    def _compute(self, words: list[str]) -> list[bytes]:
        """Ids of strings without a space that stand behind one. Behind a line end inside, no space stands."""
        cut = [w.split("\n") for w in words]
        out = self.pieces.word_ids([lines[0] or SPACE for lines in cut])
        for i, lines in enumerate(cut):
            if len(lines) > 1:
                head = out[i] if lines[0] else self.parts(SPACE)
                out[i] = self.line_end.join([head, *map(self.parts, lines[1:])])
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, the new ones in one call of the library."""
        held, old = self.words, self.words.old
        out = [held.get(w) or old.get(w) for w in words]
        new = [i for i, ids in enumerate(out) if ids is None and words[i]]
        for i, ids in zip(new, self._compute([words[i] for i in new]) if new else (), strict=True):
            out[i] = held.put(words[i], ids)
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a string array; NULL and empty texts have none.

        Arrow splits the texts and finds the distinct words; their ids are then gathered by word.
        """
        texts = texts.fill_null("")
        if self.pieces.joins_lines:
            return [self.parts(normal(t)) for t in texts.to_pylist()]
        lists = pc.split_pattern(texts, " ")
        coded = lists.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        out = gathered(self._ids(words), coded.indices, lists.offsets)
        # Several spaces, or one at an end, leave empty words; the space character itself counts as a space.
        odd = pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
        if "" in words:
            first = lists.offsets.to_numpy()
            empty = np.concatenate([[0], np.cumsum(coded.indices.to_numpy() == words.index(""))])
            odd = odd | (empty[first[1:]] > empty[first[:-1]])
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.parts(normal(texts[i].as_py()))
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a normal text that begins where a segment does."""
        if text[:1] != SPACE:
            return self.parts(text)
        return self.encode_column(pa.array([text[1:].replace(SPACE, " ")]))[0] if len(text) > 1 else self.parts(text)


def load(path: str) -> Segments:
    """The model and its segment cache, once per worker."""
    cache = worker_cache("pieces")
    if path not in cache:
        cache[path] = Segments(Pieces(path))
    return cache[path]
