import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text) pairs or (id, text, source) triples."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def texts(small):
    """(doc_id, text) of the smallest documents table."""
    import pyarrow.parquet as pq

    read = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"]) for r in read]
