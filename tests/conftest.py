import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ticktide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def one(spark):
    """Evaluate columns over one row of given values."""

    def run(ddl, row, **columns):
        df = spark.createDataFrame([row], ddl)
        return df.select(*[c.alias(n) for n, c in columns.items()]).first().asDict()

    return run
