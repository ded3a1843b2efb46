import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang, source]) rows; n_chars follows from the text."""

    def make(rows, schema=DOCS):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
