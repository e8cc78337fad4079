import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A data frame from tuples and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)
