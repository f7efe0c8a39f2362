import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tallyloom-tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
