import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents frame from (doc_id, text) pairs, with columns whose names could clash."""

    def make(pairs):
        rows = [(k, t, "en", "src0", None if t is None else len(t)) for k, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture
def awkward(documents):
    """NULL keys and texts, empty and blank texts, ties, repeated rows and one very long text."""
    long = "Many words stand in this long text. " * 3000
    pairs = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no key here"), (6, long), (7, long)]
    return documents(pairs)
