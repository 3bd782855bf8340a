import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from veilstream.session import local_session

    return local_session(4, partitions=4, memory="4g")


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""

    def of(df, *columns):
        got = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in got.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return of
