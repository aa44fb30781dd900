import pytest


@pytest.fixture
def docs(spark):
    """A frame of documents; columns as the table's, and one of a clashing name."""

    def make(rows):
        full = [(i, t, la, s, None if t is None else len(t), "x") for i, t, la, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n_tokens string")

    return make
