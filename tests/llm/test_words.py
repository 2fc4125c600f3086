import numpy as np
from llm_helpers import lower, shingles, words_of

from tidemark.llm.words import Words, shingle_sets, windows_hash


def test_words_equal_the_pattern(prose):
    texts = [None if t is None else t.encode() for t in prose]
    words = Words(texts, lower=True)
    want = [[w.encode() for w in words_of(lower(t))] for t in prose]
    assert words.counts().tolist() == [len(w) for w in want]
    joined, starts, ends = words.normal()
    flat = [w for ws in want for w in ws]
    assert [joined[a:b] for a, b in zip(starts, ends, strict=True)] == flat
    assert len(set(words.hashes.tolist())) == len(set(flat))


def test_hashes_do_not_depend_on_neighbours():
    alone, among = Words([b"abc def ghi"]), Words([b"x", None, b"zz abc  def\tghi"])
    assert alone.hashes.tolist() == among.hashes[2:].tolist()
    assert windows_hash(alone.hashes, 2).tolist() == windows_hash(among.hashes, 2)[2:].tolist()


def test_shingle_sets(prose):
    values, bounds = shingle_sets(Words([None if t is None else t.encode() for t in prose], lower=True), 5)
    sets = [shingles(t) for t in prose]
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    mine = [set(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for i in range(0, len(sets), 3):
        for j in range(len(sets)):
            assert len(mine[i] & mine[j]) == len(sets[i] & sets[j])
