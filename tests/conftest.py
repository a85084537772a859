import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from liftlab.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
