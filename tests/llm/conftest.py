"""Small documents with every awkward case in them."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, __text string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = "Lorem ipsum dolor sit amet, consectetur " * 6000 + "card 4111 1111 1111 1111 end"
    rows = [
        (1, "One two three four five six seven.", "en", "a", 3, "x", "y"),
        (1, "One two three four five six seven.", "en", "a", 3, "x", "y"),
        (2, "one TWO three  four\nfive six seven.", "en", None, None, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, None, None),
        (5, " \n\t ", None, "b", 4, None, None),
        (6, long, "en", "b", len(long), None, None),
        (7, long + " more", "en", "c", 1, None, None),
        (None, "One two three four five six seven.", "en", "c", 1, None, None),
        (8, "short", "en", "c", 1, None, None),
        (9, "SHORT", "en", "c", 1, None, None),
        (10, "😀 mail a@b.co and +1 (555) 555-1234, é", "en", "c", 1, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
