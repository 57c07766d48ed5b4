import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text) | (doc_id, text, lang)])`` → a documents table with columns of clashing names."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None, "x", 1, 2) for r in rows]
        return spark.createDataFrame(full, DOCS + ", ids string, leaf int, key int")

    return build
