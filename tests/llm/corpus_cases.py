"""Fixtures and fixed cases that the tests of the corpus operators import."""

from __future__ import annotations

from pathlib import Path

import pytest

TESTDATA = Path("/root/testdata")
SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, component_id long, target string, _row string, size string, "
    "kept string, sequence_id string, fp string, `_hash` string, `word` string, `start` string, `count` int"
)


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text, and columns with clashing names."""
    extra = (None, "x", "y", None, "no", "7", "ff", "h", "w", "s", 3)
    long_text = " ".join(f"word{i % 9973}x{i}" for i in range(60_000))
    rows = [
        (None, None, None, None, None, *extra),
        (None, "a text without an id, with enough words to be looked at by every rule there is in the list of rules", "en", None, 4, *extra),
        (1, None, "en", "b", None, *extra),
        (2, "", "en", "a", 0, *extra),
        (3, " \t\n\x0b\x0c\r ", None, "a", 7, *extra),
        (4, "one", "en", "c", 3, *extra),
        (5, "one two three", "en", "c", 13, *extra),
        (6, long_text, "en", "b", len(long_text), *extra),
        (7, 'naïve Öl “quote” 日本語 don\'t stop now\x1cthen, "token": abcdef123456; café 123', "fr", "b", None, *extra),
        (8, "same words again " * 30, "en", None, 10, *extra),
    ]
    return rows + [rows[-1], rows[-1], rows[5], rows[0]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] for row in documents.collect()}


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
