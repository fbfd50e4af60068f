"""The maintained result tables (Q1-Q6, Q3R, Q5, D6) as DataFrame functions.

Each function takes a mapping ``table name -> DataFrame`` with the banking contracts
(``bankroll.model``) and returns the result table. The same function serves the batch
refresh and, applied to the rows a micro-batch touched, the stream refresh.

Scale notes (what the physical plans look like):
* Q1, Q2 are map-only projections: no shuffle, filters pushed into the Parquet scan.
* Q3, Q5b, Q6 pick their aggregation order from the counted size of the account side.
  Small: broadcast it, join map-side, aggregate once (partial aggregation in every map
  task, so a hot branch or customer is combined before the shuffle). Large: reduce the
  transactions per ``(account_id, bucket)`` first, then shuffle-join and reduce per
  result key. The join input shrinks from one row per transaction to one row per
  account and bucket, and a hot account (a third of all rows) collapses to one row per
  bucket map-side, so it never makes one join task hot. Sums are exact decimals, so the
  two-level sum equals the one-level sum.
* Dimension sides are broadcast only behind a measured size bound
  (``operators.joins.bounded_broadcast``); beyond it the joins shuffle, AQE splits skewed
  partitions, and row-level joins (Q3R, Q4) salt hot keys (``operators.joins.lookup_join``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..model import CITY_HIGH_VALUE, HIGH_VALUE, Q5_MIN_ACCOUNTS, Q5_MIN_AMOUNT, WINDOW
from ..operators.joins import bounded_broadcast, lookup_join

Tables = Mapping[str, DataFrame]


def q1_transactions_by_account(t: Tables) -> DataFrame:
    """Q1: every transaction re-keyed by account, with day key and timestamp text."""
    x = t["transaction"]
    return x.select(
        "account_id",
        B.day_bucket("txn_time").alias("txn_day"),
        B.timestamp_text("txn_time").alias("txn_timestamp"),
        "txn_id", "currency", "txn_type", "channel", "status", "product_id",
        "approved_by_emp_id", "amount",
    )


def q2_high_value_by_minute(t: Tables, threshold: float = HIGH_VALUE) -> DataFrame:
    """Q2: transactions with amount strictly above ``threshold``, minute key."""
    x = t["transaction"]
    return x.filter(B.above("amount", threshold)).select(
        B.minute_bucket("txn_time").alias("txn_minute"),
        "txn_time", "txn_id", "account_id", "currency", "amount", "channel", "status",
    )


def _joined(x: DataFrame, side: DataFrame, small: bool, t: Tables) -> DataFrame:
    """Transactions with the account side: map-side if it is small, else hot keys are split."""
    if small:
        return x.join(side, "account_id")
    return lookup_join(x, side, "account_id", rows_of=t["account"])


def account_city(t: Tables) -> DataFrame:
    """account_id -> city through the account's branch (J1 side of J2)."""
    branch, _ = bounded_broadcast(t["branch"].select("branch_id", "city"), rows_of=t["branch"])
    return t["account"].select("account_id", "branch_id").join(branch, "branch_id") \
        .select("account_id", "city")


def q3_high_value_by_city(t: Tables, threshold: float = CITY_HIGH_VALUE,
                          window: str = WINDOW) -> DataFrame:
    """Q3: per tumbling event-time window and city, count of transactions above
    ``threshold`` (inner joins transaction -> account -> branch; status not filtered)."""
    hv = t["transaction"].filter(B.above("amount", threshold)) \
        .select("account_id", "txn_id", F.window("txn_time", window).alias("w"))
    cities, small = bounded_broadcast(account_city(t), rows_of=t["account"])
    if small or hv.isStreaming:  # one aggregation after the join (a stream allows only one)
        counted = (_joined(hv, cities, small, t)
                   .groupBy("w", "city").agg(F.count("txn_id").alias("txn_count")))
    else:  # reduce per (account, window) before the shuffle join
        per_account = hv.groupBy("account_id", "w").agg(F.count("txn_id").alias("n"))
        counted = (per_account.join(cities, "account_id")
                   .groupBy("w", "city").agg(F.sum("n").alias("txn_count")))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "city", "txn_count")


def q3r_high_value_rows_by_city(t: Tables, threshold: float = CITY_HIGH_VALUE,
                                split_hot: bool = True) -> DataFrame:
    """Q3R: the single high-value transactions behind Q3, with hour key and city."""
    x = t["transaction"].filter(B.above("amount", threshold)) \
        .select("txn_id", "account_id", "amount", "txn_time")
    joined = lookup_join(x, account_city(t), "account_id", split_hot=split_hot, rows_of=t["account"])
    return joined.select(
        B.hour_bucket("txn_time").alias("bucket_hour"), "city", "account_id", "txn_id", "amount",
    )


def q4_withdrawals_by_employee(t: Tables, split_hot: bool = True) -> DataFrame:
    """Q4: withdrawals with their approving employee, the employee's branch name and
    the quarter (inner joins; rows without approver or with unknown approver drop)."""
    x = t["transaction"].filter(
        (F.col("txn_type") == "Withdrawal") & F.col("approved_by_emp_id").isNotNull()
    ).select("approved_by_emp_id", "txn_time", "txn_id", "account_id", "currency", "amount")
    branch, _ = bounded_broadcast(t["branch"].select("branch_id", "branch_name"), rows_of=t["branch"])
    staff = (t["employee"].select(F.col("emp_id").alias("approved_by_emp_id"), "branch_id")
             .join(branch, "branch_id").select("approved_by_emp_id", "branch_name"))
    joined = lookup_join(x, staff, "approved_by_emp_id", split_hot=split_hot, rows_of=t["employee"])
    return joined.select(
        F.col("approved_by_emp_id").alias("employee_id"),
        B.quarter_label("txn_time").alias("quarter"),
        "txn_time", "txn_id", "account_id", "currency", "amount", "branch_name",
    )


def q5a_active_accounts(t: Tables) -> DataFrame:
    """Number of Active accounts per customer."""
    return (t["account"].filter(F.col("status") == "Active")
            .groupBy("customer_id").agg(F.count(F.lit(1)).alias("account_count")))


def q5b_customer_quarter_total(t: Tables, broadcast: bool = True) -> DataFrame:
    """Sum of amounts per customer and quarter (every type, status and currency).
    ``broadcast=False`` joins accounts on their key, for tables bucketed on it."""
    x = t["transaction"].select("account_id", B.quarter_label("txn_time").alias("quarter"), "amount")
    owners, small = t["account"].select("account_id", "customer_id"), False
    if broadcast:
        owners, small = bounded_broadcast(owners, rows_of=t["account"])
    if small or x.isStreaming:
        grouped = _joined(x, owners, small, t).groupBy("customer_id", "quarter") \
            .agg(*B.money_sum_parts("amount", "amt"))
    else:  # reduce per (account, quarter) before the shuffle join
        per_account = x.groupBy("account_id", "quarter").agg(*B.money_sum_parts("amount", "amt"))
        grouped = per_account.join(owners, "account_id").groupBy("customer_id", "quarter") \
            .agg(*B.money_resum("amt"))
    return grouped.select("customer_id", "quarter", B.money_total("amt").alias("amount"))


def q5_high_value_customers(t: Tables, min_accounts: int = Q5_MIN_ACCOUNTS,
                            min_amount: float = Q5_MIN_AMOUNT,
                            q5a: DataFrame | None = None, q5b: DataFrame | None = None) -> DataFrame:
    """Q5: customer quarters with more than ``min_accounts`` active accounts and a quarter
    total of at least ``min_amount`` (Q5b joined to Q5a)."""
    counts = (q5a if q5a is not None else q5a_active_accounts(t)) \
        .filter(F.col("account_count") > min_accounts)
    totals = (q5b if q5b is not None else q5b_customer_quarter_total(t)) \
        .filter(F.col("amount") >= min_amount)
    if not totals.isStreaming:
        counts, _ = bounded_broadcast(counts, rows_of=q5a if q5a is not None else t["account"])
    return totals.join(counts, "customer_id").select("quarter", "customer_id", "amount")


def q6_branch_daily(t: Tables, broadcast: bool = True) -> DataFrame:
    """Q6: per branch and UTC date, total and count of approved transactions.
    ``broadcast=False`` joins accounts on their key, for tables bucketed on it."""
    x = (t["transaction"].filter(F.col("status") == "approved")
         .select("account_id", B.to_day("txn_time").alias("txn_date"), "amount"))
    branches, small = t["account"].select("account_id", "branch_id"), False
    if broadcast:
        branches, small = bounded_broadcast(branches, rows_of=t["account"])
    if small or x.isStreaming:
        grouped = _joined(x, branches, small, t).groupBy("branch_id", "txn_date") \
            .agg(*B.money_sum_parts("amount", "amt"), F.count(F.lit(1)).alias("count_txn"))
    else:  # reduce per (account, date) before the shuffle join
        per_account = x.groupBy("account_id", "txn_date") \
            .agg(*B.money_sum_parts("amount", "amt"), F.count(F.lit(1)).alias("n"))
        grouped = per_account.join(branches, "account_id").groupBy("branch_id", "txn_date") \
            .agg(*B.money_resum("amt"), F.sum("n").alias("count_txn"))
    return grouped.select("branch_id", B.year_text("txn_date").alias("txn_year"), "txn_date",
                          B.money_total("amt").alias("total_amount"), "count_txn")


def d6_active_account_events(t: Tables) -> DataFrame:
    """One ``account_active`` seed event per Active account, keyed by customer.
    Counting the events per customer gives Q5a."""
    return t["account"].filter(F.col("status") == "Active").select(
        F.lit("account_active").alias("event"), "customer_id", "account_id",
    )


ROLLUPS = {
    "q1": q1_transactions_by_account,
    "q2": q2_high_value_by_minute,
    "q3": q3_high_value_by_city,
    "q3r": q3r_high_value_rows_by_city,
    "q4": q4_withdrawals_by_employee,
    "q5a": q5a_active_accounts,
    "q5b": q5b_customer_quarter_total,
    "q5": q5_high_value_customers,
    "q6": q6_branch_daily,
    "d6": d6_active_account_events,
}
