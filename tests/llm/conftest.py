import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, lang, source]) as a documents table, with a column that clashes with helpers."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s1", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        return df.selectExpr("*", "'x' AS id", "1 AS k", "'y' AS part", "0 AS size", "'z' AS label")

    return make
