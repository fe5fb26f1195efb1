import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "batch string, component_id string, size string, text_hash string, score string, word string")
EXTRA = ("b", "c", "s", "h", "x", "w")  # columns whose names an operator uses inside


@pytest.fixture(scope="session")
def make(spark):
    """documents rows from (doc_id, text[, source[, lang]]), with extra columns of clashing names."""
    def build(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a",
                 None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    words = [f"word{i % 997}" for i in range(30_000)]
    prose = "Some plain words about nothing at all, said once more and then again by someone else. " * 2
    return [(1, prose), (1, prose), (2, prose), (3, None), (4, ""), (5, " \t\n\x0b\f\r "), (6, "one"), (7, "one two"),
            (None, prose), (None, None), (8, " ".join(words), None, None), (9, "é" * 500), (10, "Ünïcode \U0001f600 text", "b")]
