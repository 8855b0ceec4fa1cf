import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with an extra column whose name the operators use inside, from (doc_id, text) pairs."""
    def make(rows):
        data = [(i, t, "en", "src0", len(t or ""), 1, "x") for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, version int, key string")
    return make
