from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts or (id, text) pairs."""
    def make(rows, schema=DOCUMENT):
        out = []
        for i, r in enumerate(rows):
            doc_id, text = r if isinstance(r, tuple) else (i, r)
            out.append((doc_id, text, "en", "s", None if text is None else len(text)))
        return spark.createDataFrame(out, schema)
    return make
