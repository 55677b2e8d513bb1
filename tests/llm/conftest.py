import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text), ...])`` -> a documents table."""
    def make(rows, lang=None):
        return spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, t in rows], DOCS)
    return make
