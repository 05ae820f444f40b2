import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from enrichkit.session import build_local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ORACLE_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_local_session("*", shuffle_partitions=8)
    yield session


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))
