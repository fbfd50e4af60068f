from __future__ import annotations

import pytest

from bankroll.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def lm(spark):
    """The session with this package's code sent to its workers."""
    return ship(spark)


@pytest.fixture(scope="session")
def documents(lm):
    return lm.read.parquet(f"{SF}/documents.parquet")
