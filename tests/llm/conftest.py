import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, key string, id string, tokens string, lang string"


@pytest.fixture(scope="session")
def prose():
    """Invented prose with copies, near copies, shared passages, odd white space and empty texts."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru", "sa", "to", "vé") for b in ("ra", "li", "no", "Ta", "xe", "zu", ".", ", ")]
    say = lambda n: [rng.choice(vocabulary).strip() for _ in range(n)]
    passage, texts = say(50), []
    for i in range(60):
        body = say(rng.choice((3, 20, 60, 200)))
        if i % 4 == 0:
            body[len(body) // 2 : len(body) // 2] = passage
        texts.append(" ".join(body))
    for i in range(0, 24, 2):
        copy = texts[i].split(" ")
        for _ in range(max(1, len(copy) // 50)):
            copy[rng.randrange(len(copy))] = "changed"
        texts += [" ".join(copy), texts[i], texts[i].upper()]
    texts += [None, "", "  \n\t ", "one", "one", "One", "a b c d", "a b c d e", "x\ty\x0bz  w\n\nv", "日本語 テスト 🎉", "\xa0nb\xa0sp " * 3]
    return texts


@pytest.fixture(scope="session")
def docs(spark, prose):
    """Rows (doc_id, text) with columns whose names operators use inside; one row twice."""
    rows = [(i, t, "k", "i", "t", "l") for i, t in enumerate(prose)]
    return spark.createDataFrame([*rows, rows[7]], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
