"""Small builders for the training-data operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text) of the smallest driver table."""
    import duckdb

    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()


#: Odd texts that every operator must take.
ODD = ["", None, " \t\n ", "\n\n", "a", "\x00", "é ü ß 漢字 😀", "x" * 300_000, "word " * 40_000, "\x1c\x1d 　 z"]


@pytest.fixture(scope="session")
def odd():
    return [(i, t) for i, t in enumerate(ODD)]
