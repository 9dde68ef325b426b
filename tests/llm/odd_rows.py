"""Fixtures for the training-data operators: a documents table of odd cases and a few real rows."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, id long, bucket long, label long, key long, spans string"


def _row(i, text, lang="en"):
    # extra columns, with names that operators use inside
    return (i, text, lang, None, None if text is None else len(text), 1, 2, 3, 4, 5, "x")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a repeated row, a very long word and a long text."""
    long_text = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
    rows = [_row(1, None), _row(2, ""), _row(3, " \n\t "), _row(4, "one"), _row(5, "one two three", None), _row(6, "x" * 50_000),
            _row(7, long_text, "de"), _row(8, long_text, "de"), _row(9, "é" * 700 + " 😀 ok", "fr"), _row(9, "é" * 700 + " 😀 ok", "fr"),
            _row(None, "a text without a key " * 20), _row(11, "a text with a key " * 30)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
