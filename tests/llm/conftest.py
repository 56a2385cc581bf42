import pytest
from pyspark.sql import Row


@pytest.fixture()
def documents(spark):
    """Rows as a table with the columns of documents and one whose name clashes."""

    def make(rows):
        shape = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"
        full = [
            (i, t, "en", f"src{k % 3}", None if t is None else len(t), 0.5, "x") for k, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(full, shape)

    return make


@pytest.fixture()
def by_id():
    def make(df, key="doc_id"):
        out = {}
        for r in df.collect():
            assert isinstance(r, Row)
            out.setdefault(r[key], []).append(r)
        return out

    return make
