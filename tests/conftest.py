import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from claimlake.session import local_session

    s = local_session(4, shuffle_partitions=4, app="claimlake-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-free comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
