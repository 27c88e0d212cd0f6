import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wardstat.session import build_session

    s = build_session("local[4]", app_name="wardstat-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as plain tuples, sorted for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
