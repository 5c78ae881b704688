import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tierline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()),
                      key=lambda t: tuple((v is not None, str(v)) for v in t))
    return collect
