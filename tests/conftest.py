from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from fixtures import SF_SMALL, VIEWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from bankroll.session import get_session

    s = get_session("local[4]", app_name="bankroll-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for v in VIEWS:
        p = f"{SF_SMALL}/{v}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {v} as select * from read_parquet('{p}')")
    return con


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleaned by rm)."""
    return tempfile.mkdtemp(prefix="bankroll-test-")
