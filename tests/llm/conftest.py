import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, target string, size string, component string"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text[, source]) rows, with extra columns of names that operators use themselves."""

    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows], DOCUMENTS)
    return make
