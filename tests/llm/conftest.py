import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from texts or (id, text) pairs, with all columns of the table."""
    def make(*texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS)
    return make


@pytest.fixture
def by_id():
    """Rows of a frame by their first column; ids must be unique."""
    def collect(df):
        rows = df.collect()
        found = {r[0]: r for r in rows}
        assert len(found) == len(rows)
        return found
    return collect


@pytest.fixture(scope="session")
def duck():
    return duckdb.connect()
