"""Boundary rows (thresholds, bucket edges, nulls, statuses) on hand-built tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bankroll.plans import rollups as R
from fixtures import account, branch, tables, txn


def ids(df, col="txn_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_q2_threshold_is_strict(spark):
    t = tables(spark, [txn("t1", amount=10000.00), txn("t2", amount=10000.01)])
    assert ids(R.q2_high_value_by_minute(t)) == ["t2"]


def test_q3_threshold_is_strict_and_status_not_filtered(spark):
    t = tables(spark, [txn("t1", amount=50000.00), txn("t2", amount=50000.01, status="declined")])
    rows = R.q3_high_value_by_city(t).collect()
    assert [(r.city, r.txn_count) for r in rows] == [("Pune", 1)]
    assert ids(R.q3r_high_value_rows_by_city(t)) == ["t2"]


def test_hour_edge(spark):
    t = tables(spark, [txn("t1", amount=60000, when="2025-01-01T00:59:59.999Z"),
                       txn("t2", amount=60000, when="2025-01-01T01:00:00.000Z")])
    rows = sorted(R.q3_high_value_by_city(t).collect())
    assert [r.window_start.replace(tzinfo=None) for r in rows] == [
        dt.datetime(2025, 1, 1, 0, 0), dt.datetime(2025, 1, 1, 1, 0)]
    assert all(r.window_end - r.window_start == dt.timedelta(hours=1) for r in rows)
    hours = sorted(r.bucket_hour for r in R.q3r_high_value_rows_by_city(t).collect())
    assert hours == ["2025010100", "2025010101"]


def test_quarter_edge(spark):
    t = tables(spark, [txn("t1", txn_type="Withdrawal", when="2025-03-31T23:59:59.999Z"),
                       txn("t2", txn_type="Withdrawal", when="2025-04-01T00:00:00Z")])
    q = {r.txn_id: r.quarter for r in R.q4_withdrawals_by_employee(t).collect()}
    assert q == {"t1": "2025Q1", "t2": "2025Q2"}
    q5b = sorted((r.quarter, r.amount) for r in R.q5b_customer_quarter_total(t).collect())
    assert q5b == [("2025Q1", 100.0), ("2025Q2", 100.0)]


def test_buckets_ignore_session_zone_setting(spark):
    """Buckets are UTC even if someone moved the session zone; the library pins it."""
    from bankroll.catalog import run_query  # noqa: F401  (run_query pins UTC)
    from bankroll.session import use_utc

    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    use_utc(spark)
    t = tables(spark, [txn("t1", when="2025-01-01T23:30:00Z")])
    r = R.q1_transactions_by_account(t).collect()[0]
    assert (r.txn_day, r.txn_timestamp) == ("20250101", "2025-01-01T23:30:00.000000")


def test_null_and_unknown_approver(spark):
    t = tables(spark, [txn("t1", txn_type="Withdrawal", approver=None),
                       txn("t2", txn_type="Withdrawal", approver="ghost"),
                       txn("t3", txn_type="Withdrawal", approver="e1")])
    assert ids(R.q4_withdrawals_by_employee(t)) == ["t3"]
    assert ids(R.q1_transactions_by_account(t)) == ["t1", "t2", "t3"]


def test_q6_counts_only_approved(spark):
    t = tables(spark, [txn("t1", status="approved", amount=1.10),
                       txn("t2", status="pending"), txn("t3", status="declined")])
    rows = R.q6_branch_daily(t).collect()
    assert [(r.branch_id, r.txn_year, r.txn_date, r.total_amount, r.count_txn) for r in rows] == [
        ("b1", "2025", dt.date(2025, 1, 15), 1.10, 1)]


def test_q5a_only_active(spark):
    accts = [account("a1", status="Active"), account("a2", status="Inactive"),
             account("a3", status="Frozen"), account("a4", status="Closed"),
             account("a5", customer_id="c2", status="Inactive")]
    t = tables(spark, accounts=accts)
    assert [(r.customer_id, r.account_count) for r in R.q5a_active_accounts(t).collect()] == [("c1", 1)]


def test_q5_bounds(spark):
    # c5: 5 active accounts, c6: 6 active accounts; quarter sums 999999.99 vs 1000000.00
    accts = [account(f"c5-{i}", customer_id="c5") for i in range(5)] + \
            [account(f"c6-{i}", customer_id="c6") for i in range(6)]
    txns = [txn("x1", account_id="c5-0", amount=1000000.00),
            txn("x2", account_id="c6-0", amount=999999.99, when="2025-01-02T00:00:00Z"),
            txn("x3", account_id="c6-1", amount=1000000.00, when="2025-05-02T00:00:00Z")]
    out = [(r.quarter, r.customer_id, r.amount) for r in
           R.q5_high_value_customers(tables(spark, txns, accts)).collect()]
    assert out == [("2025Q2", "c6", 1000000.0)]


def test_same_instant_kept_in_q1(spark):
    t = tables(spark, [txn("t1"), txn("t2")])
    assert ids(R.q1_transactions_by_account(t)) == ["t1", "t2"]


def test_q1_timestamp_text_and_day(spark):
    t = tables(spark, [txn("t1", when="2025-07-04T05:06:07.123Z")])
    r = R.q1_transactions_by_account(t).collect()[0]
    assert (r.txn_day, r.txn_timestamp) == ("20250704", "2025-07-04T05:06:07.123000")
    m = R.q2_high_value_by_minute(tables(spark, [txn("t1", amount=20000,
                                                     when="2025-07-04T05:06:07Z")])).collect()[0]
    assert m.txn_minute == "202507040506"


def test_d6_count_equals_q5a(spark):
    accts = [account("a1"), account("a2"), account("a3", customer_id="c2"),
             account("a4", status="Frozen")]
    t = tables(spark, accounts=accts)
    per_customer = R.d6_active_account_events(t).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("account_count"))
    assert sorted(per_customer.collect()) == sorted(R.q5a_active_accounts(t).collect())


def test_branch_city_join_uses_current_branch_row(spark):
    t = tables(spark, [txn("t1", amount=70000)], branches=[branch("b1", "Delhi")])
    assert [r.city for r in R.q3_high_value_by_city(t).collect()] == ["Delhi"]


def test_nan_amount_is_never_high_value_and_sums_like_double(spark):
    nan = float("nan")
    t = tables(spark, [txn("t1", amount=nan), txn("t2", amount=60000.0),
                       txn("t3", amount=1.10, when="2025-02-01T00:00:00Z")])
    assert ids(R.q2_high_value_by_minute(t)) == ["t2"]
    assert [r.txn_count for r in R.q3_high_value_by_city(t).collect()] == [1]
    sums = {r.txn_date.day: r.total_amount for r in R.q6_branch_daily(t).collect()}
    import math
    assert math.isnan(sums[15]) and sums[1] == 1.10
    q5b = {r.quarter: r.amount for r in R.q5b_customer_quarter_total(t).collect()}
    assert math.isnan(q5b["2025Q1"])


def test_amounts_below_a_cent_are_not_rounded(spark):
    """1,000 amounts of 0.004 are 4.0, in the map-side plan and in the shuffle plan."""
    from bankroll.operators import joins

    for rows in (None, "0"):
        if rows:
            spark.conf.set(joins.CONF_MAX_BROADCAST_ROWS, rows)
        try:
            t = tables(spark, txns=[txn(f"t{k}", amount=0.004) for k in range(1000)])
            assert R.q6_branch_daily(t).first().total_amount == 4.0
            assert R.q5b_customer_quarter_total(t).first().amount == 4.0
            t = tables(spark, txns=[txn("t1", amount=1e-15), txn("t2", amount=1.0)])  # beyond twelve places
            assert R.q6_branch_daily(t).first().total_amount == 1.0 + 1e-15
        finally:
            spark.conf.unset(joins.CONF_MAX_BROADCAST_ROWS)
