"""Vector codes, spelling variants and line dedup against plain definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import line_index, lines, spelling, vector_codes


# Line dedup


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def without_lines(rows, chars=20, least=3):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= chars:
                holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(holders.get(key_of(x), ())) < least or max(holders[key_of(x)]) == i]
        out.append((i, len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def paged(spark):
    rng = random.Random(4)
    common = [f"This line is shared by many pages, number {k}" for k in range(30)]
    near = ["x" * 19, "é" * 19, "é" * 20, " " * 30 + "short", "日本語テスト" * 4]
    rows = []
    for i in range(120):
        own = [f"only document {i} has this line, {rng.random()}" for _ in range(rng.randrange(4))]
        body = own + rng.sample(common, rng.randrange(6)) + rng.sample(near, 2)
        body = [rng.choice((x, x.upper(), f" \t{x}\r", x)) for x in body] + body[:1]
        rng.shuffle(body)
        rows.append((i % 110, "\n".join(body)))
    giant = "\n".join(rng.choice(common) if k % 3 else f"giant line number {k} {rng.random()}" for k in range(20_000))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, "\n".join(common)), (503, giant), (504, "\x00" * 25), (505, "\x00" * 25), (506, "\x00" * 25)]
    rows += [rows[3], rows[3]]
    return rows


SCHEMA = "doc_id long, text string, id string, key string, gone string, n_lines string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "i", "k", "g", "n") for i, t in rows], SCHEMA).repartition(parts)


def test_line_dedup_equals_the_definition(spark, paged, rows_of):
    got = rows_of(lines.drop_repeated_lines(frame(spark, paged)), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(without_lines(paged), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
    assert sum(r[2] for r in got) > 100


@pytest.mark.parametrize("in_task", [0, 12, 25])
def test_lines_beyond_the_tasks_arrays_are_probed_at_their_shards(spark, paged, rows_of, monkeypatch, in_task):
    monkeypatch.setattr(lines, "IN_TASK", in_task)
    monkeypatch.setattr(lines, "_BLOCK_LINES", 50)
    got = lines.drop_repeated_lines(frame(spark, paged))
    assert "CoGroup" in got._jdf.queryExecution().toString()
    want = sorted(without_lines(paged), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_line_dedup_of_an_empty_table(spark):
    assert lines.drop_repeated_lines(frame(spark, [], 1)).collect() == []


def test_a_document_of_many_rows_counts_once(spark):
    rows = [(1, "a line of more than twenty letters")] * 5 + [(2, "a line of more than twenty letters")]
    assert {r["n_dropped"] for r in lines.drop_repeated_lines(frame(spark, rows)).collect()} == {0}


def test_perfect_hash_numbers_every_line_once_and_knows_strangers():
    rng = np.random.default_rng(1)
    made = []
    for shard, n in enumerate((1, 5, 1000, 50_000)):
        first = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(5) + np.uint64(shard)
        first = first - first % np.uint64(5) + np.uint64(shard)
        made.append((shard, first, rng.integers(0, 1 << 63, n, dtype=np.uint64), np.arange(n), np.arange(n) * 7 + shard))
    rows = [line_index.shard_row(*m) for m in made]
    index = line_index.LineIndex(rows, 5)
    assert len(index) == 51_006
    assert sum(len(r["bits"]) for r in rows) * 8 < 5 * len(index)
    for _, first, second, counts, keepers in made:
        numbers = index.probe(first, second)
        assert len(set(numbers.tolist())) == len(first) and numbers.min() >= 0
        assert index.counts[numbers].tolist() == counts.tolist()
        assert index.keepers[numbers].tolist() == keepers.tolist()
        assert (index.probe(first, second + np.uint64(1)) == -1).all()
    other = rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)
    assert (index.probe(other, other) == -1).all()


# Spelling variants


def words_by_definition(rows, every=199):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = key_of(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            out[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_definition(words, ratio=5):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return out


def test_word_counts_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_BLOCK_WORDS", 20)
    rng = random.Random(2)
    bases = ["ÀÉîöü", "Straße", "wörtlich", "Examples", "naïveté", "multi×ply", "ab", "kelvinK", "áccent", "漢字kanjis", "under_scores", "ﬁxture"]
    rows = [(i, " ".join(rng.choice(bases) + rng.choice(("", "a", "-é", "1")) for _ in range(200))) for i in range(40)]
    rows += [(None, "Straße naïveté " * 50), (77, None), (78, ""), (79, "x" * 100_000 + " " + ("longest" * 3000 + " ") * 5)]
    for every in (199, 7):
        got = {r["word"]: r["n"] for r in spelling.count_words(frame(spark, rows), every=every).collect()}
        assert got == words_by_definition(rows, every)


@pytest.mark.parametrize("letters", ["ab", "abcdé", "a日𝒳"])
def test_variants_equal_the_definition(spark, letters):
    """Dense words over few letters: many runs of equal letters, chains of forms, ties."""
    rng = random.Random(letters)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))): 5 ** rng.randrange(6) + rng.randrange(2) for _ in range(300)}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(7))
    assert {tuple(r) for r in got.collect()} == variants_by_definition(words)


def test_variants_of_prose(spark, prose):
    rows = [(i, f"{t} {'greatest ' * 300} greetest greatests grettests grettests {'grettest ' * 9} ") for i, t in enumerate(prose)]
    words = words_by_definition(rows)
    got = spelling.variants(spelling.count_words(frame(spark, rows), every=199))
    assert {tuple(r) for r in got.collect()} == variants_by_definition(words)
    assert any(r[1] for r in variants_by_definition(words))


def test_variants_in_many_ranges(spark, monkeypatch):
    """Trie nodes keep their numbers over the borders of ranges."""
    monkeypatch.setattr(spelling, "parts", lambda *_: 40)
    words = {f"pre{'fix' * 20}{a}{b}{'suffix' * 20}": 5 + 30 * (a == b) for a in "abcdefgh" for b in "abcdefghij"}
    words |= {"p": 3, "pr": 99, "pre" + "fix" * 20: 4, "x" * 5000: 7, "x" * 5001: 70}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {tuple(r) for r in got.collect()} == variants_by_definition(words)


def test_variants_edge_cases(spark):
    none = spark.createDataFrame([], "word string, n long, id long, p string")
    assert spelling.variants(none).collect() == []
    repeated = spark.createDataFrame([("abc", 2), ("abc", 3), (None, 9), ("abd", 30), ("", 4), ("a", 1)], "word string, n long")
    assert {tuple(r) for r in spelling.variants(repeated).collect()} == variants_by_definition({"abc": 5, "abd": 30, "": 4, "a": 1})
    with pytest.raises(ValueError, match="ratio"):
        spelling.variants(repeated, ratio=1)


# Vector codes


def codes_by_definition(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    dims = -(-max((len(r[1]) for r in kept), default=0) // parts) * parts
    ints = [[math.floor(256 * x) for x in r[1]] + [0] * (dims - len(r[1])) for r in kept]
    width = dims // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        mine = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
        for p in range(parts):
            groups = defaultdict(list)
            for v, code in zip(cut, mine, strict=True):
                groups[code[p]].append(v[p])
            for e, members in groups.items():
                books[p][e] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    out, of_label = [], Counter()
    for r, v in zip(kept, cut, strict=True):
        code = [nearest(p, v[p]) for p in range(parts)]
        error = sum(far(v[p], books[p][e]) for p, e in enumerate(code))
        of_label[r[2]] += error
        out.append((r[0], "".join(f"{e:02x}" for e in code), error, r[2]))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, of_label[label]) for i, c, e, label in out), digest


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(6)]
    rows = [(i * 3, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.choice((None, 1, 2))) for i in range(n)]
    rng.shuffle(rows)
    return rows


CASES = {
    "clusters": vectors(1, 300, 32),
    "ties": [(i, [float((i * 7 + d) % 3 - 1) / 256 for d in range(16)], i % 2) for i in range(200)],
    "one vector many times": [(i // 2, [0.25, -0.5] * 8, None) for i in range(150)],
    "few rows": vectors(2, 5, 16),
    "wide values": vectors(3, 90, 16, 40_000.0),
    "wider values": vectors(4, 90, 16, 200_000.0),
    "unequal lengths": [(i, [0.1 * i + d for d in range(10 + i % 30)], 1) for i in range(80)] + [(99, [], 2)],
    "bad rows": vectors(5, 80, 16) + [(1, None, 1), (2, [0.1] * 15 + [None], 1), (4, [float("nan")] * 16, 1), (5, [float("inf")] * 16, 1), (None, [0.5] * 16, 3), (None, None, None)],
    "only bad rows": [(1, None, 1)],
    "only empty vectors": [(1, [], 1), (2, [], 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_vector_codes_equal_the_definition(spark, case):
    rows = CASES[case]
    table = spark.createDataFrame([(*r, "c", 0, 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, id int, error int")
    coded, books = vector_codes.compress(table.repartition(4))
    want, digest = codes_by_definition(rows)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in coded.collect()) == want
    assert vector_codes.codebook_digest(books) == digest


def test_vector_codes_refuse_errors_beyond_a_long(spark):
    table = spark.createDataFrame([(1, [1e30] * 16, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table)


def test_active_entries_answer_like_a_full_scan():
    rng = np.random.default_rng(7)
    for _ in range(50):
        x, entries = rng.integers(-3, 4, (200, 3)), rng.integers(-3, 4, (12, 3))
        code, far = vector_codes.full_scan(x, entries)
        moved = rng.random(12) < rng.random()
        new = np.where(moved[:, None], rng.integers(-3, 4, (12, 3)), entries)
        got, want = vector_codes.active_scan(x, new, moved, code, far), vector_codes.full_scan(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
