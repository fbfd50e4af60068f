"""Aggregates kept by signed differences equal their rollups after every change."""
from __future__ import annotations

import pytest
from fixtures import account, branch, tables, txn
from helpers import multiset, spark_rows

from bankroll.plans import rollups as R
from bankroll.streaming import signed

BRANCHES = [branch("b1", "Pune"), branch("b2", "Delhi")]
ACCOUNTS = [account("a1", "c1", "b1"), account("a2", "c2", "b2")]
FIRST = [txn(f"t{k}", "a1" if k % 3 else "a2", 60_000.0 + k / 100, f"2025-0{1 + k % 6}-15T10:00:00Z") for k in range(30)]
ODD = [txn("n1", "a1", float("nan")), txn("n2", "a1", float("inf")), txn("n3", "a2", 1e300), txn("n4", "a9", 5.0),
       txn("n5", "a2", 0.1 + 0.2), txn("n6", "a1", 1e-13)]


@pytest.mark.parametrize("name", signed.SIGNED)
def test_sum_of_differences(spark, name):
    steps = [
        (FIRST, ACCOUNTS, BRANCHES),
        (FIRST + ODD, ACCOUNTS, BRANCHES),                                          # amounts that are no exact decimals
        (FIRST[5:] + ODD[4:], [account("a1", "c2", "b2"), ACCOUNTS[1]], BRANCHES),  # rows go, an account moves
        ([dict(x, amount=x["amount"] / 7) for x in FIRST[5:]], ACCOUNTS, [branch("b1", "Goa"), BRANCHES[1]]),
        ([], ACCOUNTS, BRANCHES)]
    before, stored = tables(spark), None
    for txns, accounts, branches in steps:
        after = tables(spark, txns, accounts, branches)
        change = signed.difference(name, before, after)
        stored = change if stored is None else signed.folded(stored.unionByName(change), name)
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        want = R.ROLLUPS[name](after)
        got = signed.totals(stored, name)
        assert sorted(got.columns) == sorted(want.columns)
        assert multiset(*spark_rows(got)) == multiset(*spark_rows(want.select(*got.columns)))
        before = after
    assert stored.count() == 0  # all was taken back exactly
