import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from winnow.session import build_session  # noqa: E402

TEST_CONF = {
    "spark.sql.shuffle.partitions": "4",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "4g",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **TEST_CONF)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect as sorted tuples."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return collect
