"""Bucketed tables join without an exchange; Bloom filters skip row groups."""
from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from bankroll import catalog
from bankroll.plans import rollups as R
from bankroll.sources import layout, testdata
from fixtures import SF_SMALL
from helpers import assert_same


@pytest.fixture()
def no_runtime_broadcast(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["q5b", "q6"])
def test_no_exchange_below_the_join(spark, duck, no_runtime_broadcast, name):
    t = catalog._bucketed(spark, SF_SMALL, "transaction", "account")
    df = R.ROLLUPS[name](t, broadcast=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert "SortMergeJoin" in plan and "Exchange" not in plan[join:], plan
    assert plan[:join].count("Exchange") == 1        # of the join's results to their groups
    assert f"SelectedBucketsCount: {catalog.BUCKETS} out of {catalog.BUCKETS}" in plan
    assert_same(catalog.present(df), duck, E.oracle_sql()[name])


def _scanned(df) -> int:
    """Rows that the scan of a filtered read gave on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_a_lookup_without_the_layouts_keys_skips_row_groups(spark, scratch):
    q1 = R.q1_transactions_by_account(testdata.tables(spark, SF_SMALL))
    some = q1.select("txn_id").orderBy("txn_id").limit(2001).collect()
    wanted = some[2000].txn_id                       # amid all ids: no statistics exclude it
    seen = {}
    for label, lookups in (("bloom", None), ("plain", {})):
        path = f"{scratch}/{label}"
        layout.write_result(q1, "q1", path, partitions=2, lookups=lookups)
        found = layout.read_result(spark, path).filter(f"txn_id = '{wanted}'")
        assert [r.txn_id for r in found.collect()] == [wanted]
        seen[label] = _scanned(found)
    files = glob.glob(f"{scratch}/bloom/**/*.parquet", recursive=True)
    months = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert seen["plain"] > 10 * seen["bloom"] and seen["bloom"] <= 3 * max(months), (seen, max(months))


def test_the_filters_of_unknown_columns_are_none(spark):
    assert layout.bloom_options({}) == {}
    assert layout.bloom_options({"a": 5}) == {"parquet.bloom.filter.enabled#a": "true",
                                              "parquet.bloom.filter.expected.ndv#a": "5"}


def test_parts_grow_with_the_transactions(spark):
    """buckets and state partitions hold a bounded number of rows each."""
    n = testdata.tables(spark, SF_SMALL)["transaction"].count()
    assert catalog._parts(spark, SF_SMALL, n // 20) >= 20 and catalog._parts(spark, SF_SMALL, n) == catalog.BUCKETS
