from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents frame from (doc_id, text) or longer tuples."""

    def build(rows):
        full = [(*row, *("en", "src0", len(row[1] or ""))[len(row) - 2 :]) for row in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def odd(make):
    """Nulls, empty and blank texts, repeated rows, ties, and one long text."""
    return make([
        (None, None), (None, "lone text"), (1, ""), (2, "   \n\t"), (3, None), (4, "short"), (4, "short"),
        (5, prose(5, 60)), (6, prose(5, 60)), (6, prose(5, 60)), (7, "a" * 3000), (8, prose(8, 4000)), (9, "é中\x1c🙂 " * 40),
    ])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
