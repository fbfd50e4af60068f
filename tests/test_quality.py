"""Quality checks count seeded violations exactly."""
from __future__ import annotations

import datetime as dt

import pytest

from bankroll.operators import quality as Q
from fixtures import account, branch, employee, frame, ts, txn


def _violations(df):
    return {(r.tbl, r.item): r.violations for r in df.collect()}


def tables(spark):
    txns = [txn("t1", account_id="a1"), txn("t2", account_id="ghost"),
            txn("t3", account_id="ghost"), txn("t4", account_id="ghost", approver="nobody"),
            txn("t4", amount=float("nan")), txn("t5", amount=0.5, currency="XYZ"),
            txn("t6", amount=150000.01), txn("t7", amount=12.345)]
    accts = [account("a1"), account("a2", status="Inactive", closed=None),
             account("a3", status="Active", closed=ts("2024-01-01T00:00:00Z")), account("a4", status="Bogus")]
    emps = [employee("e1", role="Manager"), employee("e2", manager_id="e1"),
            employee("e3", manager_id="e2"), employee("e4", manager_id=None)]
    cust = frame(spark, "customer", [{"customer_id": "c1", "name": "N", "dob": dt.date(1990, 1, 1),
                                      "customer_segment": "Retail", "pan_hash": "X", "city": "Pune",
                                      "created_at": None}])
    prod = frame(spark, "product", [{"product_id": "p1", "product_name": "S", "product_category": "Loan"}])
    return {"transaction": frame(spark, "transaction", txns), "account": frame(spark, "account", accts),
            "branch": frame(spark, "branch", [branch("b1", "Pune")]),
            "employee": frame(spark, "employee", emps), "customer": cust, "product": prod}


def test_counts(spark):
    t = tables(spark)
    qc1 = _violations(Q.qc1_domains(t))
    assert qc1[("transaction", "currency")] == 1 and qc1[("account", "status")] == 1
    qc2 = _violations(Q.qc2_not_null(t))
    assert qc2[("transaction", "amount_nan")] == 1
    qc3 = _violations(Q.qc3_foreign_keys(t))
    assert qc3[("transaction", "account_id->account.account_id")] == 3      # hot orphan key
    assert qc3[("transaction", "approved_by_emp_id->employee.emp_id")] == 1
    assert qc3[("employee", "manager_id->employee.emp_id")] == 0
    qc4 = _violations(Q.qc4_primary_keys(t))
    assert qc4[("transaction", "txn_id")] == 1
    qc5 = _violations(Q.qc5_hierarchy(t))
    assert qc5 == {("employee", "root"): 1, ("employee", "manager_share"): 0,
                   ("employee", "bad_manager_link"): 1}
    assert _violations(Q.qc6_closed_at(t))[("account", "closed_at_iff_inactive")] == 2
    qc7 = _violations(Q.qc7_amounts(t))
    # NaN is not within [1, 150000] (nor two-decimal); 0.5 and 150000.01 are out of range
    assert qc7[("transaction", "amount_range")] == 3
    assert qc7[("transaction", "amount_two_decimals")] == 2
    shares = {(r.col, r.value): (r.n, r.target) for r in Q.qc8_shares(t).collect()}
    assert shares[("status", "approved")][0] == 8
    assert shares[("currency", "XYZ")] == (1, None)
    assert shares[("currency", "USD")] == (0, 0.5)


def test_orphans_lists_rows(spark):
    from bankroll.operators.joins import orphans

    t = tables(spark)
    rows = orphans(t["transaction"], "account_id", t["account"], "account_id").select("txn_id").collect()
    assert sorted(r.txn_id for r in rows) == ["t2", "t3", "t4"]


def _tree(spark, rows, **options):
    staff = [employee(e, manager_id=m) for e, m in rows]
    got = _violations(Q.qc5_reachability({"employee": frame(spark, "employee", staff)}, **options))
    return got["employee", "below_missing_manager"], got["employee", "in_or_below_cycle"]


def test_employees_that_no_root_reaches(spark):
    chain = [(f"x{k}", f"x{k - 1}" if k else None) for k in range(9)]
    assert _tree(spark, []) == (0, 0)
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT"):
        _tree(spark, chain, max_levels=5)
    cycle = [("a", "c"), ("b", "a"), ("c", "b"), ("below", "a"), ("self", "self")]
    lost = [("l1", "nobody"), ("l2", "l1"), ("l3", "l1")]
    assert _tree(spark, chain + cycle + lost) == (3, 5)
    # repeated ids count once; one that has a manager in any row is no root
    assert _tree(spark, [("r", None), ("r", None), ("d", None), ("d", "e"), ("e", "d"), ("e", "d")]) == (0, 2)
