import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def prose():
    """A function that makes n words from a seed."""

    def make(seed, n, pool=400):
        rng = np.random.default_rng(seed)
        return [f"w{x}" for x in rng.integers(0, pool, n)]

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns with unlucky names."""
    long = " ".join(f"long{i}" for i in range(120_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 10), (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 10),
        (2, None, "en", None, None), (3, "", None, "b", 0), (4, " \n\t ", "de", "b", 3), (5, long, "en", "c", len(long)), (6, long, "en", "c", len(long)),
        (None, "a text without an id but with some words in it", None, None, None), (None, None, None, None, None), (7, "ß", "de", "d", 1),
        (8, "日本語 のテキスト", None, "e", 1), (9, "1234 5678", "en", "e", 9),
    ]
    clash = "class int, component int, score double, key int, node int, _id string, _text string, label int, spans string, row int"
    more = [(*r, 0, 0, 0.5, 1, 2, "x", "y", 3, "z", 4) for r in rows]
    return spark.createDataFrame(more, f"{DOCS}, {clash}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
