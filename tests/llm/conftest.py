import pytest


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table of documents, with columns that clash with the operators' own."""

    def make(rows, ids="bigint"):
        full = [(i, t, "en", f"src{(i or 0) % 4}", len(t or ""), "x", 7, True, "y") for i, t in rows]
        return spark.createDataFrame(full, f"doc_id {ids}, text string, lang string, source string, n_chars bigint, keep_id string, n bigint, kept boolean, id string").repartition(3)

    return make


@pytest.fixture
def collect():
    """doc_id -> row, or a sorted list where ids repeat."""
    return lambda df: {r.doc_id: r for r in df.collect()}
