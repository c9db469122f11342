import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def make(spark):
    """documents from rows (doc_id, text, lang, source), with columns whose names the operators use inside."""

    def build(rows):
        full = [(i, t, lang, source, len(t or ""), "x", 1, "y") for i, t, lang, source in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, node string, part int, size string"
        return spark.createDataFrame(full, schema)

    return build


ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "one", "en", None), (4, "one", "en", None),
    (None, "two words", None, "b"), (7, "a b c d e f g " * 3000, "de", "b"), (8, "\n\n x \n X\n", "en", "a"), (9, "é" * 50_000, "fr", ""),
]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)
