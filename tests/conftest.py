import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 2)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def as_dicts(df, *keys):
    """Rows keyed by some of their columns."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}
