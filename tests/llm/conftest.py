from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that carry names the operators use themselves.
EXTRA = ", size long, row long, kept boolean, doc string, taken long, slot long, words string, node long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        rows = [(i, t, None, s, len(t or "")) for i, t, s in rows]
        if extra:
            rows = [(*r, 1, 2, None, "x", 3, 4, "y", 5) for r in rows]
        return spark.createDataFrame(rows, DOCS + EXTRA * extra)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n", None),
        (4, "one two three four five six seven", "b"),
        (5, "one  two three\tfour five six seven", "b"),
        (5, "one  two three\tfour five six seven", "b"),
        (None, "one two three four five six seven", None),
        (None, None, None),
        (7, long, "a"),
        (8, long + " end", "a"),
        (9, "x", "c"),
    ]
