import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citeweave.session import build_session  # noqa: E402
from citeweave.staging import Staging  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    return Staging(spark, "test")


@pytest.fixture
def frame(spark):
    """Build a DataFrame from tuples and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def values():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(row) for row in df.collect()), key=repr)
