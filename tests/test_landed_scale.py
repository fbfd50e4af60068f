"""What the landed refresh compares by id, and how the feeds of the stream queries are sent."""
from __future__ import annotations

import glob

from fixtures import SF_SMALL, frame, txn
from pyspark.sql import functions as F

from bankroll import catalog
from bankroll.streaming.landed import LandedRefresh


def test_only_repeated_ids_are_compared(spark, scratch):
    ref = LandedRefresh(spark, f"{scratch}/state", results=("q6",), check_ids=False)
    first, second = [("t1", "2025-01-15T10:00:00Z"), ("t2", "2025-01-16T10:00:00Z")], [
        ("t1", "2025-03-15T10:00:00Z"), ("t3", "2025-01-17T10:00:00Z")]
    for n, rows in enumerate((first, second)):
        good = frame(spark, "transaction", [txn(i, "a1", 5.0, at) for i, at in rows]).withColumn(
            "seq", F.lit(n).cast("long"))
        ref._land_transactions(good, n)
    assert ref._repeats(0).count() == 0
    assert [r.txn_id for r in ref._repeats(1).collect()] == ["t1"]
    got = {(r.role, r.txn_id, r.txn_time.month) for r in ref._by_role(
        "q6", 1, ["202501"], True, True).collect()}
    assert got == {("new", "t1", 3), ("old", "t1", 1), ("rest", "t2", 1), ("new", "t3", 1)}


def test_a_send_is_packed_files_of_each_split(spark):
    feed = catalog._Feed(spark, SF_SMALL, kinds=("transaction",))
    rows = frame(spark, "transaction", [txn(f"t{k}", "a1", 5.0) for k in range(40)]).repartition(4)
    feed.send("transaction", rows)
    assert len(glob.glob(f"{feed.src['transaction']}/*.json.gz")) == 5  # an empty one from the start
    assert spark.read.json(feed.src["transaction"]).count() == 40
