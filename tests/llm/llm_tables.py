"""Small tables for the operator tests."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
