"""Byte-level BPE of whole texts with the tokenizers library, many texts at a time.

The vocabulary's splitter never puts a boundary inside what it calls a token, and none of its
tokens holds white space after something else. So a text can be cut wherever plain white space
follows another character; numpy finds these places in the bytes of all texts, Arrow the distinct
stretches between them, and each of those is encoded once per worker.
"""

from __future__ import annotations

import gc
import re

import numpy as np
import pyarrow as pa

from tidemark.llm.workers import worker_cache

# Characters that the splitter may take for white space too, or did in some version: no cut after one of them.
_ODD_CHARS = [chr(c) for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
_ODD = re.compile("[" + "".join(_ODD_CHARS) + "]")
_ODD_BYTES = np.array([int.from_bytes(c.encode(), "big") for c in _ODD_CHARS])
_MOST_KEPT = 1_200_000
_LONGEST_KEPT = 200  # bytes; longer stretches hardly come again
_TOGETHER = 50  # words that one call encodes as one text
_SPACE, _LINE = "Ġ", "Ċ"  # a space and a line feed in the tokens of byte-level vocabularies


def _bytes_in(chars: str | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[c if isinstance(c, int) else ord(c) for c in chars]] = True
    return table


_WHITE, _MARK, _PLAIN = _bytes_in(" \t\n\v\f\r"), _bytes_in(",.;:!?"), _bytes_in(range(0x21, 0x7F))
_LETTER = _bytes_in([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_DOUBT = _bytes_in([*range(0x1C, 0x20), *range(0x80, 0x100)])


def _cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where stretches begin in the bytes of texts that lie one after the other and begin at ``begins``."""
    cut = np.zeros(len(data), dtype=bool)
    white = _WHITE[data]
    np.greater(white[1:], white[:-1], out=cut[1:])
    doubt = np.flatnonzero(cut[1:] & _DOUBT[data[:-1]]) + 1
    before = sum(data[np.maximum(doubt - i, 0)].astype(np.int64) << (8 * i - 8) for i in (1, 2, 3))
    odd = np.isin(before, _ODD_BYTES) | np.isin(before & 0xFFFF, _ODD_BYTES) | np.isin(before & 0xFF, _ODD_BYTES)
    cut[doubt[odd]] = False
    cut[begins] = True
    # The splitter always parts a letter (here A-Z and those of U+00C0 to U+00FF) from a mark behind it,
    marks = np.flatnonzero(_MARK[data[1:]]) + 1
    last = data[marks - 1]
    latin = (last >= 0x80) & (data[marks - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)
    cut[marks[_LETTER[last] | latin]] = True
    # and a single line feed from a plain character behind it.
    cut[np.flatnonzero(cut[:-1] & (data[:-1] == 0x0A) & _PLAIN[data[1:]]) + 1] = True
    return np.flatnonzero(cut)


class _Kept(dict):
    """Ids of stretches (as UTF-8), as little-endian 16- or 32-bit numbers."""

    def __init__(self, tokenizer, kind: str):
        self.tokenizer, self.kind = tokenizer, kind
        vocabulary = tokenizer.get_vocab()
        # Tokens that begin with a space: in a row of words, each with a space before it, only first tokens do.
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocabulary.items() if token[0] == _SPACE]] = True
        self.line = vocabulary.get(_LINE, -1)

    def _encode(self, keys: list[bytes]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([k.decode() for k in keys], add_special_tokens=False) if keys else ()
        return [np.array(c.ids, dtype=self.kind).tobytes() for c in coded]

    def _encode_row(self, keys: list[bytes], lines: bool) -> list[bytes]:
        """Words as one text, each with its space or on a line of its own: half the cost of a call for each."""
        text = (b"\n" + b"\n".join(keys) if lines else b"".join(keys)).decode()
        if _ODD.search(text):
            return self._encode(keys)
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, dtype=self.kind)
        begins = np.flatnonzero(ids == self.line if lines else self.opens[ids])
        if len(begins) != len(keys):
            return self._encode(keys)
        row, size = ids.tobytes(), ids.itemsize
        ends = [*(begins[1:] * size).tolist(), len(row)]
        return [row[begin:end] for begin, end in zip(((begins + lines) * size).tolist(), ends, strict=True)]

    def _learn(self, keys: list[bytes]) -> dict[bytes, bytes]:
        # A space and a word, a word or mark without white space before it, and the rest. White space elsewhere
        # in a stretch comes after an odd character only, which a row is searched for.
        words, firsts, others = [], [], []
        for key in keys:
            (words if key[0] == 0x20 and key[1:2] > b" " else firsts if 0x20 < key[0] < 0x7F else others).append(key)
        new = dict(zip(others, self._encode(others), strict=True))
        for row, lines in ((words, False), (firsts, True)):
            for begin in range(0, len(row), _TOGETHER):
                some = row[begin : begin + _TOGETHER]
                new.update(zip(some, self._encode_row(some, lines), strict=True))
        if len(self) + len(new) > _MOST_KEPT:
            self.clear()
        self.update(new if max(map(len, new)) <= _LONGEST_KEPT else {k: v for k, v in new.items() if len(k) <= _LONGEST_KEPT})
        gc.freeze()  # keeps the collector from walking the cache again and again
        return new

    def ids(self, keys: list[bytes]) -> list[bytes]:
        found = list(map(self.get, keys))
        if None in found:
            new = self._learn([k for k, v in zip(keys, found, strict=True) if v is None])
            found = [new[k] if v is None else v for k, v in zip(keys, found, strict=True)]
        return found


def encoder(path: str, kind: str):
    """A function from texts (a list or an Arrow array) to their ids as bytes of ``kind`` ('<u2' or '<u4'). Loaded once per worker."""
    cache = worker_cache("byte_bpe")
    if (path, kind) not in cache:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        cache[path, kind] = _Kept(Tokenizer.from_file(path), kind)
    kept = cache[path, kind]

    def encode(texts: list[str | None] | pa.Array) -> list[bytes]:
        whole = (pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())).fill_null("")
        _, bounds, data = whole.buffers()
        bounds = np.frombuffer(bounds, dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, dtype=np.int64)
        if bounds[0] == bounds[-1]:
            return [b""] * len(whole)
        data = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        begins = _cuts(data, bounds[bounds < len(data)])
        spans = pa.py_buffer(np.append(begins, len(data)))
        stretches = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, spans, pa.py_buffer(data)]).dictionary_encode()
        joined = pa.array(kept.ids(stretches.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(stretches.indices)
        _, places, ids = joined.buffers()
        places = np.frombuffer(places, dtype=np.int64)[np.searchsorted(begins, bounds)].tolist()
        ids = memoryview(ids)
        return [bytes(ids[begin:end]) for begin, end in zip(places[:-1], places[1:], strict=True)]

    return encode


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
