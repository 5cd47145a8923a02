import datetime as dt
import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from spendloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(ddl, *tuples) -> DataFrame; rows_of(df) sorts by all columns."""

    def make(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    return make


@pytest.fixture
def utc():
    return lambda *a: dt.datetime(*a)
