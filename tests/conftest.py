import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from prosemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4)
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """The value of a column expression over literals."""

    def value(column):
        return spark.range(1).select(column.alias("x")).first().x

    return value
