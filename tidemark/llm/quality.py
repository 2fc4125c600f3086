"""Quality classifier: a weak-label model over heuristic labellers teaches a hashed linear scorer.

Method. Heuristic labellers look at one trait each and vote good, bad or nothing. How often each vote
pattern occurs is counted over all documents (3 ** labellers patterns at most). Expectation-maximisation
on these counts estimates, for either class, how often each labeller votes what, and so its accuracy;
no hand labels are used. Each pattern then has a posterior. A bounded sample of documents
(``SAMPLE``, by hash of the id) with these posteriors trains a logistic scorer on hashed traits
of words (first and last characters, length, repetition), which then scores every document whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import fixed_sample
from tidemark.llm.words import U64, Words, column, mix, portions

SAMPLE = 6000  # documents the scorer is trained on, at most
DIMS = 2048
GOOD, BAD, NONE = 0, 1, 2
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".?!"]] = True
_SYMBOL = ~(_LETTER | _DIGIT)
_SYMBOL[[ord(c) for c in " \t\n\r\f\v.,;:?!'\"()-"]] = False

# Trait, bad from, good up to: a value between them gets no vote. Traits are shares of a text's words or bytes.
LABELLERS = (
    ("symbols", 0.08, 0.02),
    ("capitals", 0.5, 0.2),
    ("repeats", 0.3, 0.05),
    ("sameness", 0.75, 0.5),
    ("bare_marks", 0.12, 0.03),
    ("exclaims", 0.3, 0.05),
    ("odd_lengths", 0.6, 0.3),
    ("repeated_lines", 0.5, 0.1),
)
PATTERNS = 3 ** len(LABELLERS)


def _shares(flags: np.ndarray, words: Words) -> np.ndarray:
    """Share of flagged words of each text; 0 without words."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(words.counts(), 1)


def traits(words: Words, texts: list[bytes | None]) -> np.ndarray:
    """One row of trait values per text, in the order of LABELLERS."""
    n, text = words.counts(), words.text
    length = words.ends - words.starts
    sizes = np.array([len(t or b"") for t in texts])
    begins = np.cumsum(sizes + 1) - sizes - 1

    def in_bytes(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[text])])
        return sums[begins + sizes] - sums[begins]

    hashes = words.hashes
    same = np.zeros(len(words), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.first[:-1][n > 0]] = False
    owner = words.text_of_word()
    _, at = np.unique(mix(hashes + mix(owner.astype(U64))), return_index=True)
    distinct = np.bincount(owner[at], minlength=len(n))
    last = text[words.ends - 1]
    lines = [[x for x in (t or b"").split(b"\n") if len(x) > 20] for t in texts]
    return np.stack(
        [
            in_bytes(_SYMBOL) / np.maximum(sizes, 1),
            in_bytes(_UPPER) / np.maximum(in_bytes(_LETTER), 1),
            _shares(same, words),
            np.where(n >= 30, 1 - distinct / np.maximum(n, 1), 0) * np.minimum(1, 200 / np.maximum(n, 1)) ** 0.25,
            _shares((length == 1) & ~(_LETTER | _DIGIT)[last], words),
            _shares(last == ord("!"), words),
            _shares((length > 24) | ((length == 1) & _LETTER[last]), words),
            np.array([1 - len(set(x)) / len(x) if len(x) > 3 else 0.0 for x in lines]),
        ],
        axis=1,
    )


def patterns(values: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Vote pattern of each text as a number in base 3. Texts below 5 words get no votes."""
    code = np.zeros(len(values), dtype=np.int64)
    for k, (_, bad, good) in enumerate(LABELLERS):
        vote = np.where(values[:, k] >= bad, BAD, np.where(values[:, k] <= good, GOOD, NONE))
        code = code * 3 + np.where(n_words < 5, NONE, vote)
    return code


def expectation_maximisation(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good for each pattern, and P(vote | class) as (labeller, class, vote).

    A bad text usually has one fault and is fine otherwise, so bad is not one class: there is the good
    class and, for each labeller, the class of texts with its fault. A pattern starts as good if no
    labeller objects, else mostly as the classes of those that do. Rounds then estimate how often each
    class draws each vote; a labeller that objects to many texts others find nothing in loses weight
    only where its votes also come from other classes. A small floor keeps every vote possible. A
    pattern without votes has the share of good texts among all others.
    """
    n = len(LABELLERS)
    votes = np.stack([codes // 3**k % 3 for k in range(n - 1, -1, -1)], axis=1)
    objects = (votes == BAD).astype(np.float64)
    any_ = objects.sum(axis=1, keepdims=True)
    silent = (votes == NONE).all(axis=1)  # these say nothing, and teach nothing
    counts = np.where(silent, 0.0, counts)
    classes = np.concatenate([np.where(any_ > 0, 0.05, 1.0), np.where(any_ > 0, 0.95 * objects / np.maximum(any_, 1), 0.0)], axis=1)
    table = np.zeros((n, n + 1, 3))
    for _ in range(rounds):
        weight = classes * counts[:, None]
        for vote in range(3):
            table[:, :, vote] = (votes == vote).T.astype(np.float64) @ weight
        table = (table + 0.01) / (table + 0.01).sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=0) + 0.01) / (weight + 0.01 / max(len(codes), 1)).sum()
        logs = np.log(prior)[None, :] + sum(np.log(table[k][:, votes[:, k]]).T for k in range(n))
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - classes).max() < 1e-9:
            break
        classes = new
    share = (classes[:, 0] @ counts + 1) / (counts.sum() + 1)
    return np.where(silent, share, classes[:, 0]), table


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed traits of words: (text, feature, share of the text's words), each pair once."""
    if not len(words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    text, hashes = words.text, words.hashes
    kind = np.select([_UPPER, _LETTER, _DIGIT], [1, 2, 3], 0).astype(U64)
    first, last = kind[text[words.starts]], text[words.ends - 1].astype(U64)
    last = np.where(_LETTER[text[words.ends - 1]], kind[text[words.ends - 1]] + U64(300), last)
    length = np.minimum(words.ends - words.starts, 30).astype(U64) // U64(3)
    same = np.zeros(len(words), dtype=U64)
    same[1:] = hashes[1:] == hashes[:-1]
    before = np.concatenate([[U64(0)], last[:-1]])
    owner = words.text_of_word()
    found = [mix(first | last << U64(4) | same << U64(16) | U64(1 << 20)), mix(length | last << U64(4) | U64(2 << 20)), mix(before | last << U64(10) | U64(3 << 20))]
    codes = np.concatenate([owner * DIMS + (f % U64(DIMS)).astype(np.int64) for f in found])
    pair, times = np.unique(codes, return_counts=True)
    return pair // DIMS, pair % DIMS, times / words.counts()[pair // DIMS]


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic scorer for soft labels."""
    x = np.zeros((len(rows), DIMS + 1), dtype=np.float32)
    for i, (feature, share) in enumerate(rows):
        x[i, feature] = np.sqrt(share)
    x[:, DIMS] = 1
    y = labels.astype(np.float32)
    weights, step, speed = np.zeros(DIMS + 1, dtype=np.float32), np.zeros(DIMS + 1), np.zeros(DIMS + 1)
    # Either class weighs the same.
    weight = y / max(y.sum(), 1e-6) + (1 - y) / max((1 - y).sum(), 1e-6)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 1e-4 * weights
        step = 0.9 * step + 0.1 * gradient
        speed = 0.999 * speed + 0.001 * gradient**2
        weights = (weights - 0.1 * (step / (1 - 0.9**t)) / (np.sqrt(speed / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return weights.astype(np.float64)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in portions(batches, "text"):
        words = Words(texts)
        codes, counts = np.unique(patterns(traits(words, texts), words.counts()), return_counts=True)
        yield pa.record_batch([pa.array(codes), pa.array(counts)], names=["pattern", "n"])


def _scores(words: Words, weights: np.ndarray) -> np.ndarray:
    n = words.counts()
    owner, feature, share = features(words)
    sums = np.bincount(owner, weights=weights[feature] * np.sqrt(share), minlength=len(n)) + weights[DIMS]
    return np.where(n > 0, 1 / (1 + np.exp(-np.clip(sums, -30, 30))), 0.0)


def _judge(posterior: dict[int, float], weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in portions(batches, "text"):
            words = Words(texts)
            n = words.counts()
            weak = [posterior[c] for c in patterns(traits(words, texts), n).tolist()]
            score = _scores(words, weights.value)
            yield pa.record_batch(
                [column(batch, "id"), pa.array(n, pa.int64()), pa.array(weak, pa.float64()), pa.array(score), pa.array(score >= 0.5)],
                names=["id", "n_words", "weak_label", "score", "keep"],
            )

    return run


def _filter(posterior: dict[int, float], weights, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in portions(batches, text_column):
            yield batch.filter(pa.array(_scores(Words(texts), weights.value) >= 0.5))

    return run


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, n_words, weak_label, score, keep) per document.

    ``weak_label`` is the posterior of the document's votes, ``score`` the scorer's probability of good;
    ``keep`` is score >= 0.5. NULL, empty and blank texts score 0 and aren't kept; a text of a few words
    gets no votes but a score. Whole texts are judged; equal rows get equal results. An empty
    table gives an empty result. Other columns are ignored.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(docs.dtypes)["id"]
    judged = docs.mapInArrow(_judge(*fit(docs, sample)), f"id {kind}, n_words long, weak_label double, score double, keep boolean")
    return judged.withColumnRenamed("id", id_column)


def fit(docs: DataFrame, sample: int = SAMPLE):
    """Posteriors by pattern, and the scorer's weights (broadcast), of documents (id, text)."""
    counted = docs.select("text").mapInArrow(_vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    codes, counts = (np.array([r[k] for r in counted], dtype=np.int64) for k in ("pattern", "n"))
    posterior, _ = expectation_maximisation(codes, counts.astype(np.float64)) if len(codes) else (np.zeros(0), None)
    table = dict(zip(codes.tolist(), posterior.tolist(), strict=True))
    chosen = fixed_sample(docs.filter("length(text) > 0"), sample).select("text")
    # The sample's texts stay in their tasks; features come back.
    rows = chosen.mapInArrow(_sampled(table), "label double, feature array<int>, share array<float>").collect()
    usable = [(np.array(r["feature"], dtype=np.int64), np.array(r["share"])) for r in rows]
    weights = train(usable, np.array([r["label"] for r in rows])) if rows else np.zeros(DIMS + 1)
    return table, docs.sparkSession.sparkContext.broadcast(weights)


def _sampled(posterior: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in portions(batches, "text"):
            words = Words(texts)
            n = words.counts()
            labels = [posterior[c] for c in patterns(traits(words, texts), n).tolist()]
            owner, feature, share = features(words)
            edges = np.searchsorted(owner, np.arange(len(n) + 1))
            some = [i for i in range(len(n)) if n[i]]
            yield pa.record_batch(
                [
                    pa.array([labels[i] for i in some], pa.float64()),
                    pa.array([feature[edges[i] : edges[i + 1]].astype(np.int32) for i in some], pa.list_(pa.int32())),
                    pa.array([share[edges[i] : edges[i + 1]].astype(np.float32) for i in some], pa.list_(pa.float32())),
                ],
                names=["label", "feature", "share"],
            )

    return run


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier keeps, with all their columns; each row is judged by its text. No shuffle."""
    table, weights = fit(docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")), sample)
    return docs.mapInArrow(_filter(table, weights, text_column), docs.schema)
