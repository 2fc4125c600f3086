"""Substring dedup, n-gram join and decontamination against plain definitions."""

import random

import pytest
from llm_helpers import classes, shingles, without_repeats
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, substrings
from tidemark.llm.components import components
from tidemark.llm.containment import contained_items, decontaminate
from tidemark.llm.trie import SimilarSets


def test_substring_dedup_equals_the_definition(docs, rows_of):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = rows_of(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(without_repeats(rows))
    assert any(r[2] for r in got)


def test_substring_dedup_with_frequent_minimisers_last(spark, rows_of, monkeypatch):
    """The list of frequent minimisers changes buckets, never results; blocks of any size agree."""
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"own{i} " * (i % 50) + line + f" end{i}" * 40) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(without_repeats(rows))
    for most, block in ((50_000, 24 << 20), (0, 2000)):
        monkeypatch.setattr(substrings, "MOST_FREQUENT", most)
        monkeypatch.setattr(substrings, "_BLOCK_BYTES", block)
        assert rows_of(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_ngram_join_equals_the_definition(docs, rows_of):
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    want = classes(sets)
    got = rows_of(ngram_join.similar_classes(docs))
    assert set(got) == {(i, len(sets[i]), want[i]) for i in sets}
    assert len(got) == docs.count()


def test_ngram_join_of_a_large_near_copy_group(spark, monkeypatch):
    """More near copies than a group holds, beside documents that share only a passage."""
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    rng = random.Random(3)
    body = [f"b{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(40):
        copy = list(body)
        copy[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    for i in range(40, 60):
        rows.append((i, " ".join([f"o{rng.randrange(500)}" for _ in range(80)] + body[:60])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = classes({i: shingles(t) for i, t in rows})
    assert {r[0]: r[2] for r in ngram_join.similar_classes(docs).collect()} == want


def test_trie_finds_what_comparison_finds():
    rng = random.Random(1)
    sets = []
    for _ in range(150):
        base = sets[rng.randrange(len(sets))] if sets and rng.random() < 0.6 else sorted(rng.sample(range(400), rng.randrange(1, 60)))
        sets.append(sorted(set(base) ^ set(rng.sample(range(400), rng.randrange(0, 8)))) or [1])
    join, parent = SimilarSets(80), {}
    links = [(i, j) for i, s in enumerate(sets) for j in join.add(s)]
    want = classes(dict(enumerate(map(set, sets))))
    for i in range(len(sets)):
        parent[i] = i
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {i: find(i) for i in parent} == want
    assert len(links) < len(sets)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(31)) and all(got[100 + i] == 100 for i in range(40))


@pytest.fixture(scope="module")
def benchmark(spark, prose):
    passage = " ".join((prose[0] or "").split(" ")[:45])
    return spark.createDataFrame([(1, passage), (2, "one"), (3, None), (4, ""), (5, "a b c d e"), (6, " ".join(f"q{i}" for i in range(30)))], "item_id long, text string")


def test_contained_items_equal_the_definition(docs, benchmark, rows_of):
    items = {r["item_id"]: shingles(r["text"]) for r in benchmark.collect()}
    want = sorted(
        (r["doc_id"], i, len(s & mine), len(s))
        for r in docs.collect()
        for mine in [shingles(r["text"])]
        for i, s in items.items()
        if s and 100 * len(s & mine) >= 80 * len(s)
    )
    assert want and rows_of(contained_items(docs, benchmark)) == want
    assert rows_of(contained_items(docs, benchmark, block_shingles=40)) == want  # several blocks
    clean = decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert rows_of(clean, "doc_id") == rows_of(docs.filter(~F.col("doc_id").isin([w[0] for w in want])), "doc_id")


def test_short_item_in_a_giant_document(spark):
    rng = random.Random(9)
    item = [f"i{k}" for k in range(20)]
    text = [f"g{rng.randrange(10**6)}" for _ in range(60_000)]
    text[30_000:30_000] = item
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(item[:14]))], "doc_id long, text string")
    found = contained_items(docs, spark.createDataFrame([(7, " ".join(item).upper())], "item_id long, text string"))
    assert [tuple(r) for r in found.collect()] == [(1, 7, 16, 16)]


def test_empty_tables(no_docs, docs, benchmark):
    assert substrings.remove_repeats(no_docs).count() == 0
    assert ngram_join.similar_classes(no_docs).count() == 0
    assert contained_items(no_docs, benchmark).count() == 0
    assert decontaminate(docs, benchmark.limit(0)).count() == docs.count()
