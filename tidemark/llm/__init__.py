"""Operators for building text corpora: dedup, decontamination, scans, tokenisation, quality, extraction and scoring.

Each module holds one operator as a function from DataFrame to DataFrame; ``registry`` names the
queries and their SQL twins. Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
