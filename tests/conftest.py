import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/tidemark-warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fixed(spark):
    """Rows to a frame: fixed(schema, row, row, ...)."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
