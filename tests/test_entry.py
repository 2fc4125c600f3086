import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

COUNT = """
import sys
sys.path.insert(0, {root!r})
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
from tidemark import catalog
own = set(catalog.queries())
names = set(entry.queries())
assert own <= names and set(entry.oracle_sql()) <= names
print(len(own), len(names - own))
"""


def names_without(*blocked):
    """Numbers of own and of corpus queries in a process where these modules can't be imported."""
    run = subprocess.run([sys.executable, "-c", COUNT.format(root=ROOT, blocked=blocked)], capture_output=True, text=True, check=True)
    return tuple(map(int, run.stdout.split()))


@pytest.mark.parametrize("blocked", [("public_tokenizers",), ("zstandard",), ("public_tokenizers", "zstandard"), ("tidemark.llm",)])
def test_own_queries_stay_when_the_corpus_part_cannot_be_imported(blocked):
    own, corpus = names_without(*blocked)
    assert own >= 68 and corpus == 0
