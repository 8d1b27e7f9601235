import pytest


@pytest.fixture
def docs_of(spark):
    """A table of documents from (doc_id, text) pairs, or a wider tuple."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"

    def make(*rows):
        return spark.createDataFrame(
            [r + ("en", "src0", None if r[1] is None else len(r[1]))[len(r) - 2:] for r in rows], kind)
    return make
