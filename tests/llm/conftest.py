import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, text_hash string"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text[, source]) as a documents table with more columns, two of clashing names."""

    def build(rows):
        full = []
        for row in rows:
            doc, text, source = (*row, "s")[:3]
            full.append((doc, text, None, source, len(text or ""), "own", "own"))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty, blank and very long texts, repeated rows and repeated ids."""
    return documents(
        [
            (None, None, None),
            (1, None, "a"),
            (2, "", None),
            (3, " \n\t ", "a"),
            (4, "mit license " * 30_000, "b"),
            (5, "one line of text", "b"),
            (5, "one line of text", "b"),
            (5, "another text of the same id", "b"),
            (6, "one line of text", None),
        ]
    )
