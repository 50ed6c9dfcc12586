import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=4, app="jobtide-tests")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as dictionaries, sorted by the given columns."""
    found = [r.asDict() for r in df.collect()]
    return sorted(found, key=lambda r: tuple(str(r[c]) for c in (order or sorted(found[0])))) if found else []
