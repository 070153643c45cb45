import pytest

#: Columns that an operator could trip over, and rows with nulls, ties, repeated and very short texts.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, v int, doc string, held_out int, key string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", 1, 0.5, 7, "x", 1, "k") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty, blank and repeated texts, and a very long one."""
    return [(5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "one"), (None, "one two three"), (10, "word " * 30_000), (11, "é" * 3_000)]
