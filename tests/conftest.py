import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from camlytics.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("camlytics-tests", "8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return TINY


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
