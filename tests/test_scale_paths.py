"""The large-dimension plans (shuffle joins, pre-aggregation per account and bucket,
hot-key split) give the same rows as the broadcast plans."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from bankroll.operators import joins
from bankroll.plans import rollups as R
from bankroll.sources import testdata
from fixtures import SF_SMALL
from helpers import assert_same

ORACLE = E.oracle_sql()


@pytest.fixture()
def tiny_broadcast(spark):
    spark.conf.set(joins.CONF_MAX_BROADCAST_ROWS, "10")
    spark.conf.set(joins.CONF_HOT_KEY_ROWS, "3")
    testdata._TABLES.clear()
    yield
    spark.conf.unset(joins.CONF_MAX_BROADCAST_ROWS)
    spark.conf.unset(joins.CONF_HOT_KEY_ROWS)
    testdata._TABLES.clear()


@pytest.mark.parametrize("name", ["q3", "q3r", "q4", "q5b", "q6", "q5", "r5", "qc8"])
def test_shuffle_plans_match_oracle(spark, duck, tiny_broadcast, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name != "qc8":  # the fact side now reaches its dimension through a shuffle join
        assert "SortMergeJoin" in plan
    assert_same(df, duck, ORACLE[name])


@pytest.mark.parametrize("name,fn", [("q3r", R.q3r_high_value_rows_by_city),
                                     ("q4", R.q4_withdrawals_by_employee)])
def test_hot_key_split_matches_oracle(spark, duck, tiny_broadcast, name, fn):
    from bankroll.catalog import present

    df = present(fn(testdata.tables(spark, SF_SMALL), split_hot=True))
    assert_same(df, duck, ORACLE[name])


def test_hot_key_split_routes_hot_rows(spark):
    """One key holding a third of all rows goes through the broadcast branch."""
    from pyspark.sql import functions as F

    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    dim = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    out = joins.lookup_join(fact, dim, "k", max_rows=10, hot_key_rows=100)
    assert out.count() == 3000
    assert out.filter(F.col("k") == 7).count() == 1001  # every third id, plus id 7
    assert out.filter(F.col("d") != F.col("k") * 10).count() == 0
    assert sorted(out.columns) == ["d", "k", "v"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "__salt" in plan
    left = joins.lookup_join(fact, dim.filter(F.col("k") != 7), "k", how="left", max_rows=10,
                             hot_key_rows=100)
    assert left.count() == 3000 and left.filter(F.col("d").isNull()).count() == 1001


def test_salts_follow_the_key_size(spark):
    """A key gets a salt for each ``hot_key_rows`` of its rows; nothing falls back to a plain
    join when many keys are hot."""
    from pyspark.sql import functions as F

    fact = spark.range(4000).select(F.when(F.col("id") < 2000, F.lit(-1)).otherwise(F.col("id") % 20).alias("k"),
                                    F.col("id").alias("v"))
    dim = spark.range(-1, 20).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    out = joins.lookup_join(fact, dim, "k", max_rows=4, hot_key_rows=50)  # 21 hot keys, 4 may be broadcast
    assert out.count() == 4000 and out.select("k", "v").distinct().count() == 4000
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_size_check_has_no_exchange_and_runs_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    ran, kind = [], type(spark.range(1))
    observe = kind.observe
    monkeypatch.setattr(kind, "observe", lambda self, *a: ran.append(1) or observe(self, *a))
    side = spark.range(1000).select(F.col("id").alias("k"), F.lit("abc").alias("s"))
    assert joins.measure(side, ["k", "s"]) == (1000, 1000 * (8 + 3))
    assert joins.measure(side, ["k", "s"]) == (1000, 1000 * (8 + 3)) and len(ran) == 1
    before = len(joins._MEASURED)
    del side
    import gc

    gc.collect()
    assert len(joins._MEASURED) < before
    checked = spark.range(10).observe("n", F.count(F.lit(1)))
    assert "Exchange" not in checked._jdf.queryExecution().executedPlan().toString()


def test_bytes_bound_the_broadcast(spark):
    from pyspark.sql import functions as F

    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("s"))
    spark.conf.set(joins.CONF_MAX_BROADCAST_BYTES, "1000")
    try:
        assert joins.bounded_broadcast(wide)[1] is False
    finally:
        spark.conf.unset(joins.CONF_MAX_BROADCAST_BYTES)
    assert joins.bounded_broadcast(wide)[1] is True
