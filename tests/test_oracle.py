"""Every registered query equals its DuckDB twin on the sf0.001 tables."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from helpers import assert_same
from fixtures import SF_SMALL

from bankroll.catalog import ORACLE_SQL as ORACLE, QUERIES

NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    assert_same(df, duck, ORACLE[name])


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["branch_id", "txn_year", "txn_date", "total_amount", "count_txn"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    # queries without SQL twin must be deliberate
    assert set(NAMES) - set(ORACLE) == set()
