from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, spans string, score string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with columns whose names clash with the operators' own."""
    def make(rows, schema=DOCS):
        full = [(i, t, "en", "src0", len(t or ""), -1, "mine", "mine") if len(r) == 2 else r for r in rows for i, t in [r[:2]]]
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def oracle():
    def run(sql, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            con.register(name, df)
        return con.execute(sql).df()
    return run
