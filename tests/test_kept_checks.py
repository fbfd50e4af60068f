"""QC3 and QC4 by differences equal the full checks after every batch."""
from __future__ import annotations

from pyspark.sql import types as T

from bankroll.model import SCHEMAS
from bankroll.operators import quality as Q
from bankroll.streaming import kept_checks
from fixtures import account, branch, employee, txn


def frame(spark, name, rows):
    """Rows of a table, null in required columns allowed."""
    names = [f.name for f in SCHEMAS[name]]
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMAS[name]])
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], loose)


def test_equal_to_the_full_checks_after_each_batch(spark, scratch):
    held = {name: [] for name in SCHEMAS}

    def step(n, added, removed=None):
        for name, rows in (removed or {}).items():
            for row in rows:
                held[name].remove(row)
        for name, rows in added.items():
            held[name] += rows
        kept_checks.apply(spark, scratch, n, {k: frame(spark, k, v) for k, v in added.items()},
                          {k: frame(spark, k, v) for k, v in (removed or {}).items()})
        full = {k: frame(spark, k, v) for k, v in held.items()}
        want = Q.qc3_foreign_keys(full).union(Q.qc4_primary_keys(full)).collect()
        got = kept_checks.read_view(spark, scratch).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)), n
        return {(r.tbl, r.item): r.violations for r in got}

    many = [txn(f"t{i}", account_id="a1" if i % 3 == 0 else f"a{i}", approver="e1" if i % 2 else None) for i in range(12)]
    seen = step(0, {"transaction": many})
    assert seen["transaction", "account_id->account.account_id"] == 12
    seen = step(1, {"account": [account("a1", branch_id="b1")], "employee": [employee("e1"), employee("e2", manager_id="e9")]})
    assert seen["transaction", "account_id->account.account_id"] == 7        # late parents clear their orphans
    step(2, {"branch": [branch("b1", "Pune"), branch("b1", "Delhi")], "transaction": [many[0], many[0], many[5]]})
    step(3, {"branch": [branch("b1", "Mumbai")]}, {"branch": [branch("b1", "Pune"), branch("b1", "Delhi")],
                                                   "account": [account("a1", branch_id="b1")]})
    seen = step(4, {"account": [dict(account("x"), account_id=None)] * 2, "transaction": [txn("t90", account_id="a5")]})
    assert seen["account", "account_id"] == 1                                # null keys that repeat
    step(5, {})
    step(6, {"employee": []})
    # a replayed batch changes nothing
    before = sorted(map(tuple, kept_checks.read_view(spark, scratch).collect()))
    kept_checks.apply(spark, scratch, 1, {"account": frame(spark, "account", [account("a1", branch_id="b1")]), "employee": frame(
        spark, "employee", [employee("e1"), employee("e2", manager_id="e9")])})
    assert sorted(map(tuple, kept_checks.read_view(spark, scratch).collect())) == before


def test_columns_meet_only_those_that_foreign_keys_link(spark, scratch):
    """a transaction's id is in no column's domain but its own, and equal keys of two domains stay apart."""
    at = kept_checks.COLUMNS.index
    domain = kept_checks.DOMAIN
    assert domain.count(domain[at(("transaction", "txn_id"))]) == 1
    assert domain[at(("transaction", "account_id"))] == domain[at(("account", "account_id"))]
    kept_checks.apply(spark, scratch, 0, {"transaction": frame(spark, "transaction", [txn("x", account_id="x"), txn("x", account_id="y")])})
    kept_checks.apply(spark, scratch, 1, {"account": frame(spark, "account", [account("x", branch_id="b")] * 2)})
    seen = {(r.rule, r.tbl, r.item): r.violations for r in kept_checks.read_view(spark, scratch).collect()}
    assert seen["QC4", "transaction", "txn_id"] == 1 and seen["QC4", "account", "account_id"] == 1
    assert seen["QC3", "transaction", "account_id->account.account_id"] == 1
