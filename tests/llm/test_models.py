"""Vectors, quality, language-model scores, the pipeline and the registry."""

import ast
import math
import os
import random

import duckdb
import numpy as np
import pytest
from llm_helpers import classes, lower, shingles, tree_scores, words_of
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import context_tree, lm_score, quality, registry, vectors
from tidemark.llm.containment import contained_items

DATA = "/root/testdata"


def brute_links(rows, threshold):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    near = {i: set() for i, _ in rows}
    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    label = {i: i for i in near}
    for _ in range(len(near)):
        for i in near:
            label[i] = min([label[i], *(label[j] for j in near[i])])
    return {i: (len(near[i]), label[i]) for i in near}


@pytest.mark.parametrize("block", [4096, 16])
def test_near_vectors_equal_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(90):
        v = rng.normal(size=24) if i % 3 == 0 else np.array(rows[i - i % 3][1]) + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.4])
        rows.append((i, v.tolist()))
    rows += [(100 + i, rows[0][1]) for i in range(12)] + [(120, (np.array(rows[3][1]) * 7).tolist())]
    rows += [(130, None), (131, []), (132, [0.0] * 24), (133, [1.0, None] * 12), (134, [float("nan")] * 24), (135, [float("inf")] * 24), (136, [1.0, 2.0]), (137, [2.0, 4.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, id int").repartition(4)
    got = {r[0]: (r[1], r[2], r[3]) for r in vectors.near_vectors(frame).collect()}
    want = brute_links(rows, 0.95)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    assert want[136] == (1, 136) and want[100][0] >= 12


def test_near_vectors_of_empty_and_repeated_rows(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    got = sorted(map(tuple, vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    assert [r[0] for r in got] == [1, 1, 2] and got[0] == got[1] and got[2] == (2, 0, 2, True)


def test_quality_against_hand_labels(spark):
    """The labels are not used in training: all of them are held out."""
    folder = f"{DATA}/sf0.01"
    judged = quality.judge(registry.table(spark, folder, "documents"))
    rows = judged.join(registry.table(spark, folder, "labels"), "doc_id").select("quality", "keep").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_quality_edge_cases(spark, docs, no_docs):
    got = quality.judge(docs)
    assert got.columns == ["doc_id", "n_words", "weak_label", "score", "keep"] and got.count() == docs.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    empty = [r["doc_id"] for r in docs.filter("trim(coalesce(text, '')) = '' or text = '  \n\t '").collect()]
    assert empty and not any(rows[i]["keep"] or rows[i]["score"] for i in empty)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["keep"] for r in got.collect())
    assert quality.judge(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0


def test_expectation_maximisation_trusts_faults_that_stand_alone():
    n = len(quality.LABELLERS)
    clean, first = 0, quality.BAD * 3 ** (n - 1)
    both = first + quality.BAD * 3 ** (n - 2)
    posterior, table = quality.expectation_maximisation(np.array([clean, first, both, 3**n - 1]), np.array([900.0, 50.0, 50.0, 5.0]))
    # Good and bad fall on either side of one half.
    assert posterior[0] > 0.99 and posterior[1] < 0.5 and posterior[2] < 0.5
    assert np.allclose(table.sum(axis=2), 1)


def test_scores_equal_the_textbook(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["The", "cat", "Sat", "on", "émat", "x.", "tHe"]) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    rows += [(50, None), (51, "only here"), (52, "\t a\nb ")]
    frame = spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, held string").repartition(3)
    want = tree_scores(rows)
    for most in (50_000, 2):
        lm_score.FREQUENT = most
        got = lm_score.score(frame).collect()
        assert len(got) == len(rows)
        for row in got:
            held, n, known, total, base, score = want[row["doc_id"]]
            assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (held, n, known, total)
            assert abs(row["base_score"] - base) < 1e-8 and abs(row["score"] - score) < 1e-6
            coded = len(" ".join(words_of(lower(dict(rows)[row["doc_id"]]))).encode()) + 1  # with the end
            assert row["bits_per_byte"] == pytest.approx(-row["score"] * math.log2(10) / coded)
    lm_score.FREQUENT = 50_000


def test_scores_in_several_blocks_and_of_repeated_rows(spark, docs, no_docs):
    keyed = docs.select(F.col("doc_id").alias("key"), (F.col("doc_id") % 10 == 0).alias("held"), "text")
    one, many = (dict(lm_score.tree_scores(keyed, n).select("key", "score").collect()) for n in (10**6, 500))
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-8 for k in one)
    got = lm_score.score(docs)
    assert got.count() == docs.count()
    assert got.filter("doc_id = 7").distinct().count() == 1
    assert lm_score.score(no_docs).count() == 0


def test_tree_probabilities_sum_to_one():
    data = np.frombuffer(b"\n\n\n\nabracadabra abracadabra\n", dtype=np.uint8).astype(np.uint64)
    keys, counts = np.unique(context_tree.runs(data), return_counts=True)
    every = np.array([(int(keys[0]) & ~255) | b for b in range(256)], dtype=np.uint64)
    names = np.union1d(keys, every)
    times = np.zeros(len(names), dtype=np.int64)
    times[np.searchsorted(names, keys)] = counts
    below = context_tree.levels(names, times)
    top = context_tree.top_levels(*context_tree.summary(below[context_tree.TOP]))
    assert abs((10 ** context_tree.log10_probability(every, below, top)).sum() - 1) < 1e-9


def test_pipeline_stages_do_what_they_say(spark):
    """Each stage against the plain definition, on what the stage before it kept."""
    folder = f"{DATA}/sf0.001"
    docs = registry.table(spark, folder, "documents")
    benchmark = {r["item_id"]: shingles(r["text"]) for r in registry.table(spark, folder, "benchmark").collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        if name == "secret_scan":  # these few documents hold none
            marked = min(before)
            before[marked] += " token = 24be64439e3e49cf46b2d7c90f3602a3 end"
            docs = docs.withColumn("text", F.when(F.col("doc_id") == marked, F.lit(before[marked])).otherwise(F.col("text")))
        out = corpus_pipeline.stored(stage(spark, docs, folder), name)
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "quality_classifier":
            want = {r["doc_id"] for r in quality.judge(docs).filter("keep").collect()}
            assert set(after) == want and 0 < len(want) < len(before)
        elif name == "ngram_jaccard_join":
            label = classes({i: shingles(t) for i, t in before.items()})
            assert set(after) == {i for i in before if label[i] == i}
        elif name == "decontamination":
            held = {i for i, t in before.items() if any(s and 100 * len(s & shingles(t)) >= 80 * len(s) for s in benchmark.values())}
            assert set(after) == set(before) - held
            assert held == {r[0] for r in contained_items(docs, registry.table(spark, folder, "benchmark")).collect()}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert {i for i, r in after.items() if r["text"] != before[i]} == {marked}
            assert after[marked]["text"].endswith(" [SECRET] end")
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name != "sentencepiece":
            assert out.columns == docs.columns
            assert name == "secret_scan" or all(r["text"] == before[i] for i, r in after.items())
            docs, before = out, {i: r["text"] for i, r in after.items()}
        else:
            assert set(after) == set(before) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in after.values())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    folder = f"{DATA}/sf0.001"
    got = registry.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_all_ten_are_registered_and_nothing_else_imports_them():
    assert sorted(int(n.split("_")[0][2:]) for n in registry.queries()) == list(range(1, 11))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "tidemark")):
        if os.sep + "llm" in folder:
            continue
        for file in files:
            if file.endswith(".py"):
                for node in ast.walk(ast.parse(open(os.path.join(folder, file)).read())):
                    assert not (isinstance(node, ast.ImportFrom) and (node.module or "").startswith("tidemark.llm"))
