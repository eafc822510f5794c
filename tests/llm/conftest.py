import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text, lang, source) rows, with an extra column."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, `Score` string"

    def make(rows):
        full = [(i, t, lang, src, len(t or ""), "x") for i, t, lang, src in rows]
        return spark.createDataFrame(full, schema)

    return make
