"""Read variants not covered by the oracle pairs."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bankroll.plans import reads as P
from bankroll.plans import rollups as R
from bankroll.sources import layout, testdata
from fixtures import SF_SMALL
from helpers import multiset, spark_rows


def test_r3_half_open_range_on_stored_and_unstored(spark, scratch):
    t = testdata.tables(spark, SF_SMALL)
    q3 = R.q3_high_value_by_city(t)
    lo, hi = dt.datetime(1996, 1, 1), dt.datetime(1996, 3, 1)
    want = q3.filter((F.col("window_start") >= F.lit(lo)) & (F.col("window_start") < F.lit(hi))) \
        .select("city", "txn_count")
    got = P.r3_city_windows(q3, start_from=lo, start_to=hi)
    layout.write_result(q3, "q3", f"{scratch}/q3", partitions=4)
    stored = P.r3_city_windows(layout.read_result(spark, f"{scratch}/q3"), start_from=lo, start_to=hi)
    assert want.count() > 0
    for df in (got, stored):
        c1, r1 = spark_rows(want)
        c2, r2 = spark_rows(df)
        assert multiset(c1, r1) == multiset(c2, r2)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_r1_and_r6_are_newest_first(spark):
    t = testdata.tables(spark, SF_SMALL)
    r1 = [r.txn_timestamp for r in P.r1_account_days(R.q1_transactions_by_account(t), 7,
                                                     "19950101", "20011231").collect()]
    assert r1 == sorted(r1, reverse=True) and r1
    r6 = [r.txn_date for r in P.r6_branch_days(R.q6_branch_daily(t), 4, "1998-01-01",
                                               "1998-12-31").collect()]
    assert r6 == sorted(r6, reverse=True) and r6


def test_r2m_key_list_equals_range_read(spark):
    t = testdata.tables(spark, SF_SMALL)
    q2 = R.q2_high_value_by_minute(t)
    keys = [r.txn_minute for r in P.minute_keys(spark, "199806151155", "199806151210").collect()]
    assert len(keys) == 16 and keys[0] == "199806151155" and keys[-1] == "199806151210"
    a = P.r2m_minute_range(q2, "199805010000", "199807312359")
    b = P.r2m_by_keys(q2, "199805010000", "199807312359")
    c1, r1 = spark_rows(a)
    c2, r2 = spark_rows(b)
    assert r1 and multiset(c1, r1) == multiset(c2, r2)
