import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples, over 3 partitions."""

    def make(rows, schema=DOCS, parts=3):
        full = [(*r, *(None,) * (5 - len(r))) for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make
