import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size string, ids string, pii string, kept string"


@pytest.fixture
def documents(spark):
    """A table of documents with columns whose names the operators would like to use."""

    def make(texts, ids=None, sources=None):
        ids = range(len(texts)) if ids is None else ids
        sources = ["a"] * len(texts) if sources is None else sources
        rows = [(i, t, None, s, None, "own", "own", "own", "own", "own") for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


ODD_TEXTS = [None, "", " \n\t ", "one", "a b", "same words here", "same words here", "x" * 50_000, "word " * 20_000, "é😀 ß\x0b\x0c\r\nzwei", "\n\n\n"]
ODD_IDS = [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 9]


@pytest.fixture
def odd(documents):
    """Missing, empty, blank and very long texts, ties, a missing id and repeated rows."""
    return documents(ODD_TEXTS + ["same words here"], ODD_IDS + [5], ["b", None] * 6)
