"""End-user reads over the maintained tables (R1-R6, R2M, R3T, R4M).

Each read takes the maintained table (a DataFrame -- in production the stored,
partitioned Parquet table of ``sources.layout``) and its parameters. Predicates are
plain column comparisons, so on the stored tables they become partition filters
(``txn_month``, ``quarter``, ``txn_year``) and Parquet min/max pushdown.
``now`` is always a parameter (never wall-clock) so reads are repeatable.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..operators.joins import bounded_broadcast


def _ts(x: datetime | str):
    return F.lit(x).cast("timestamp")


def r1_account_days(q1: DataFrame, account_id, day_from: str, day_to: str) -> DataFrame:
    """One account's transactions with ``day_from <= txn_day <= day_to`` (yyyyMMdd),
    newest first."""
    pred = (F.col("account_id") == account_id) & F.col("txn_day").between(day_from, day_to)
    if "txn_month" in q1.columns:  # stored layout: prune month partitions too
        pred &= F.col("txn_month").between(day_from[:6], day_to[:6])
    return q1.filter(pred).orderBy(F.col("txn_timestamp").desc(), F.col("txn_id"))


def r2_recent_high_value(q2: DataFrame, now: datetime | str, span: str = "1 hour") -> DataFrame:
    """R2: high-value rows with ``now - span <= txn_time <= now`` (both ends inclusive)."""
    start = B.minus_interval(now, span)
    pred = F.col("txn_time").between(start, _ts(now))
    if "txn_month" in q2.columns:  # stored layout: the month partitions of the span
        pred &= F.col("txn_month").between(F.date_format(start, "yyyyMM"),
                                           F.date_format(_ts(now), "yyyyMM"))
        return q2.filter(pred).drop("txn_month")
    return q2.filter(pred)


def r2m_minute_range(q2: DataFrame, minute_from: str, minute_to: str) -> DataFrame:
    """R2M: the rows of a range of minute keys (the per-minute partition read).

    The key range is a text range on fixed-width keys; on the stored table the month
    partitions outside ``minute_from[:6] .. minute_to[:6]`` are pruned first, and the
    files' min/max statistics on the sorted ``txn_minute`` skip the rest.
    """
    pred = F.col("txn_minute").between(minute_from, minute_to)
    if "txn_month" in q2.columns:
        pred = F.col("txn_month").between(minute_from[:6], minute_to[:6]) & pred
        return q2.filter(pred).drop("txn_month")
    return q2.filter(pred)


def minute_keys(spark, minute_from: str, minute_to: str) -> DataFrame:
    """The consecutive ``yyyyMMddHHmm`` minute keys from ``minute_from`` to ``minute_to``
    (inclusive), generated by ``sequence`` -- the key list of a per-minute partition read."""
    t0 = F.to_timestamp(F.lit(minute_from), B.MINUTE_PATTERN)
    t1 = F.to_timestamp(F.lit(minute_to), B.MINUTE_PATTERN)
    return spark.range(1).select(
        F.explode(F.sequence(t0, t1, F.expr("INTERVAL 1 MINUTE"))).alias("t")
    ).select(B.minute_bucket("t").alias("txn_minute"))


def r2m_by_keys(q2: DataFrame, minute_from: str, minute_to: str) -> DataFrame:
    """R2M through the minute key list (the reference's "query up to 60 consecutive
    partition keys"): a semi join with the generated keys, broadcast after its size check.
    Same rows as ``r2m_minute_range``."""
    keys, _ = bounded_broadcast(minute_keys(q2.sparkSession, minute_from, minute_to))
    out = q2
    if "txn_month" in q2.columns:
        out = q2.filter(F.col("txn_month").between(minute_from[:6], minute_to[:6])).drop("txn_month")
    return out.join(keys, "txn_minute", "left_semi")


def r3_city_windows(q3: DataFrame, now: datetime | str | None = None, span: str = "24 hours",
                    start_from: datetime | str | None = None,
                    start_to: datetime | str | None = None) -> DataFrame:
    """``(city, txn_count)`` of windows starting in ``[now - span, now]`` (inclusive),
    or, with ``start_from``/``start_to``, in the half-open range ``[start_from, start_to)``."""
    if start_from is not None:
        pred = (F.col("window_start") >= _ts(start_from)) & (F.col("window_start") < _ts(start_to))
    else:
        start, end = B.minus_interval(now, span), _ts(now)
        pred = F.col("window_start").between(start, end)
    if "txn_month" in q3.columns:
        lo = _ts(start_from) if start_from is not None else start
        hi = _ts(start_to) if start_from is not None else end
        pred &= F.col("txn_month").between(F.date_format(lo, "yyyyMM"), F.date_format(hi, "yyyyMM"))
    return q3.filter(pred).select("city", "txn_count")


def r3t_city_totals(q3: DataFrame, now: datetime | str, span: str = "24 hours") -> DataFrame:
    """R3T: per city, the total count over the windows of R3 (A5: sum of window counts)."""
    return r3_city_windows(q3, now, span).groupBy("city").agg(F.sum("txn_count").alias("txn_count"))


def r4_employee_quarter(q4: DataFrame, employee_id, quarter: str) -> DataFrame:
    """One employee's withdrawals in one quarter (``YYYYQn``)."""
    return q4.filter((F.col("employee_id") == employee_id) & (F.col("quarter") == quarter))


def r4m_manager_quarter(q4: DataFrame, employee: DataFrame, manager_id, quarter: str) -> DataFrame:
    """R4M: withdrawals in ``quarter`` approved by the direct reports of ``manager_id``
    (J6: semi join against the manager's reports)."""
    reports, _ = bounded_broadcast(employee.filter(F.col("manager_id") == manager_id)
                                   .select(F.col("emp_id").alias("employee_id")))
    return q4.filter(F.col("quarter") == quarter).join(reports, "employee_id", "left_semi")


def r6_branch_days(q6: DataFrame, branch_id, date_from: str, date_to: str) -> DataFrame:
    """One branch's daily totals with ``date_from <= txn_date <= date_to``, newest first."""
    pred = (F.col("branch_id") == branch_id) & F.col("txn_date").between(
        F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    if "txn_year" in q6.columns:
        pred &= F.col("txn_year").between(date_from[:4], date_to[:4])
    return q6.filter(pred).select("txn_date", "total_amount", "count_txn") \
        .orderBy(F.col("txn_date").desc())
