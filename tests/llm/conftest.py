"""Fixtures of the outer folder serve here too."""

import pytest


@pytest.fixture()
def check_s_like(spark):
    """Documents with every awkward case: nulls, empties, repeats, long text, clashing extra columns."""
    base = "The quick brown fox jumps over the lazy dog near the river bank today "
    rows = [
        (1, base * 3, "en", "a", 1, 9, "x"),
        (2, base * 3, "en", "a", 1, 9, "x"),
        (2, base * 3, "en", "a", 1, 9, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, None, None),
        (5, " \n\t ", "en", "b", 3, None, None),
        (None, "a null id with words", "en", "b", 20, None, None),
        (6, "word " * 60000, "en", "a", 300000, 1, "y"),
        (7, "Émile à l'école — ça va? " * 40, "fr", "a", 1, 1, "y"),
        (8, "!!! ??? ...", "en", "a", 1, 1, "y"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string"
    return spark.createDataFrame(rows, schema)
