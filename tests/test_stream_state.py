"""Joins of streams (T6) and numbers per account on a stream."""
from __future__ import annotations

import json
import os

from fixtures import account, branch, txn
from pyspark.sql import functions as F

from bankroll.streaming import joined, numbering
from bankroll.streaming.sources import read_stream
from bankroll.sources.records import encode
from bankroll.model import SCHEMAS

PARTS = 2


def put(spark, root, kind, name, rows, seq=1):
    """Rows (dicts of the typed contract) as one file of wire records; text goes as it is."""
    os.makedirs(f"{root}/{kind}", exist_ok=True)
    with open(f"{root}/{kind}/{name}.json", "w") as out:
        for r in rows:
            out.write((r if isinstance(r, str) else json.dumps(dict(r, seq=seq))) + "\n")


def wire(spark, kind, rows):
    """Wire dicts of fixture rows."""
    df = spark.createDataFrame([tuple(r[f.name] for f in SCHEMAS[kind].fields) for r in rows], SCHEMAS[kind])
    return [r.asDict() for r in encode(df, kind).collect()]


def run_join(spark, root, **options):
    kinds = ("transaction", "account", "branch")
    for k in kinds:
        os.makedirs(f"{root}/{k}", exist_ok=True)
    q = joined.start("q3r", {k: f"{root}/{k}" for k in kinds}, f"{root}/out", available_now=True, partitions=PARTS,
                     check_ids=False, **options)
    q.awaitTermination()
    assert q.exception() is None
    return {r["txn_id"]: r["city"] for r in joined.read_view(spark, "q3r", f"{root}/out").collect()}


def test_transactions_wait_for_their_rows_and_follow_versions(spark, scratch):
    txns = wire(spark, "transaction", [txn(f"t{k}", "a1", 60_000.0) for k in range(20)] + [
        txn("small", "a1", 10.0), txn("alone", "a9", 70_000.0), txn("late", "a2", 80_000.0)])
    put(spark, scratch, "transaction", "1", txns + ["no json"])
    assert run_join(spark, scratch) == {}
    put(spark, scratch, "account", "1", wire(spark, "account", [account("a1", "c1", "b1")]))
    put(spark, scratch, "branch", "1", wire(spark, "branch", [branch("b1", "Pune"), branch("b2", "Delhi")]))
    got = run_join(spark, scratch)
    assert got == {f"t{k}": "Pune" for k in range(20)}
    put(spark, scratch, "account", "2", wire(spark, "account", [account("a1", "c1", "b2"), account("a2", "c1", "b2")]), 2)
    put(spark, scratch, "transaction", "2", txns[:3], 2)   # delivered again
    got = run_join(spark, scratch)
    assert got == {**{f"t{k}": "Delhi" for k in range(20)}, "late": "Delhi"}
    put(spark, scratch, "branch", "2", wire(spark, "branch", [branch("b2", "Goa")]), 3)
    assert set(run_join(spark, scratch).values()) == {"Goa"}


def test_one_account_is_dealt_to_all_salts(spark):
    rows = spark.range(4000).select(F.lit("a1").alias("account_id"), F.col("id").cast("string").alias("txn_id"))
    dim = spark.createDataFrame([("a1", "Pune")], "account_id string, city string")
    joined_rows = joined._met(rows, "txn_id", dim, "account_id", 8)
    assert joined_rows.columns == ["account_id", "txn_id", "city"] and joined_rows.count() == 4000
    share = rows.groupBy(F.pmod(F.xxhash64("txn_id"), F.lit(8))).count().agg(F.max("count")).first()[0]
    assert share < 700


def test_wait_bounds_the_versions_a_transaction_meets(spark, scratch):
    day = 86_400_000
    at = 1_735_725_600_000  # 2025-01-01T10:00:00Z
    put(spark, scratch, "transaction", "1", wire(spark, "transaction", [
        txn("t1", "a1", 60_000.0, "2025-01-01T10:00:00Z"), txn("t2", "a2", 60_000.0, "2025-01-01T10:00:00Z")]))
    put(spark, scratch, "branch", "1", wire(spark, "branch", [branch("b1", "Pune")]))
    put(spark, scratch, "account", "1", wire(spark, "account", [account("a1", "c", "b1")]), at + day)
    put(spark, scratch, "account", "2", wire(spark, "account", [account("a2", "c", "b1")]), at + 3 * day)
    assert run_join(spark, scratch, wait="2 days") == {"t1": "Pune"}


def test_rejected_records_have_a_reason(spark, scratch):
    for kind in ("transaction", "account", "branch"):
        put(spark, scratch, kind, "1", ["{broken"])
    streams = {k: read_stream(spark, f"{scratch}/{k}", k) for k in ("transaction", "account", "branch")}
    bad = joined.rejected("q3r", streams)
    q = (bad["transaction"].writeStream.format("parquet").option("checkpointLocation", f"{scratch}/c")
         .trigger(availableNow=True).start(f"{scratch}/bad"))
    q.awaitTermination()
    assert [r["reason"] for r in spark.read.parquet(f"{scratch}/bad").collect()] == ["unparseable record"]


def run_numbers(spark, root, delay="2 hours"):
    os.makedirs(f"{root}/transaction", exist_ok=True)
    src = read_stream(spark, f"{root}/transaction", "transaction", max_files_per_trigger=1)
    q = numbering.start(src, delay, f"{root}/out", available_now=True, partitions=PARTS, check_ids=False)
    q.awaitTermination()
    assert q.exception() is None
    rows = numbering.read_view(spark, f"{root}/out").filter("account_id <> 'z'").collect()
    return {(r["account_id"], r["place"]): r["txn_id"] for r in rows}, len(rows)


def at(hour, minute=0):
    return f"2025-01-01T{hour:02d}:{minute:02d}:00Z"


def test_shuffled_files_number_without_gaps(spark, scratch):
    first = [txn("t3", "a", 1.0, at(10, 30)), txn("t1", "a", 1.0, at(10)), txn("u1", "b", 1.0, at(10))]
    second = [txn("t2", "a", 1.0, at(10, 15)), txn("t4", "a", 1.0, at(10, 30)), txn("t1", "a", 1.0, at(10))]  # ties, t1 again
    put(spark, scratch, "transaction", "1", wire(spark, "transaction", first) + ["{broken"])
    put(spark, scratch, "transaction", "2", wire(spark, "transaction", second))
    assert run_numbers(spark, scratch) == ({}, 0)           # all of it waits
    put(spark, scratch, "transaction", "3", wire(spark, "transaction", [
        txn("t5", "a", 1.0, at(14)), txn("z1", "z", 1.0, at(15))]))
    want = {("a", 1): "t1", ("a", 2): "t2", ("a", 3): "t3", ("a", 4): "t4", ("b", 1): "u1"}
    assert run_numbers(spark, scratch) == (want, 5)         # state lives on over restarts
    put(spark, scratch, "transaction", "4", wire(spark, "transaction", [
        txn("late", "a", 1.0, at(9)), txn("z2", "z", 1.0, at(23))]))
    assert run_numbers(spark, scratch) == ({**want, ("a", 5): "t5"}, 6)  # "late" comes behind its number
    every = spark.createDataFrame([("late", "2025-01-01 09:00:00"), ("t1", "2025-01-01 10:00:00")], "txn_id string, t string")
    every = every.select("txn_id", F.col("t").cast("timestamp").alias("txn_time"))
    left = numbering.late_rows(every, numbering.read_view(spark, f"{scratch}/out"),
                               F.lit("2025-01-01 21:00:00").cast("timestamp"))
    assert [r["txn_id"] for r in left.collect()] == ["late"]


def test_an_empty_stream_has_no_numbers(spark, scratch):
    out = numbering.numbered(read_stream(spark, _folder(scratch), "transaction"), "1 hour")
    assert out.isStreaming and out.columns == ["account_id", "txn_id", "txn_time", "place"]


def _folder(root):
    os.makedirs(f"{root}/none", exist_ok=True)
    return f"{root}/none"


def test_accounts_of_one_bucket_have_their_own_numbers(spark, scratch):
    """one state for many accounts, over batches of which the first leaves rows waiting."""
    rows = {k: [txn(f"{a}{h}", a, 1.0, at(h)) for a in "abc" for h in hours] for k, hours in (("1", (9, 12)), ("2", (10, 8)))}
    rows["3"], rows["4"] = [txn("z1", "z", 1.0, at(13))], [txn("z2", "z", 1.0, at(23))]
    for name, sent in rows.items():
        put(spark, scratch, "transaction", name, wire(spark, "transaction", sent))
        src = read_stream(spark, f"{scratch}/transaction", "transaction", max_files_per_trigger=1)
        q = numbering.start(src, "5 hours", f"{scratch}/out", available_now=True, partitions=PARTS, check_ids=False, buckets=1)
        q.awaitTermination()
        assert q.exception() is None
    got = numbering.read_view(spark, f"{scratch}/out").filter("account_id <> 'z'").collect()
    assert {(r["account_id"], r["place"]): r["txn_id"] for r in got} == {
        (a, k + 1): f"{a}{h}" for a in "abc" for k, h in enumerate((8, 9, 10, 12))} and len(got) == 12


def test_only_busy_accounts_are_kept_several_times(spark):
    """the dimension row of an account that is not busy is not repeated per salt."""
    rows = spark.range(4000).select(F.when(F.col("id") < 3990, F.lit("a1")).otherwise(F.lit("a2")).alias("account_id"),
                                    F.col("id").cast("string").alias("txn_id"), F.lit(60_000.0).alias("amount"))
    busy = joined.busy_keys("q3r", rows, 100)
    assert [r["account_id"] for r in busy.collect()] == ["a1"]
    dim = spark.createDataFrame([("a1", "Pune"), ("a2", "Delhi"), ("a3", "Goa")], "account_id string, city string")
    got = joined._met(rows, "txn_id", dim, "account_id", 8, busy=busy)
    assert got.columns == ["account_id", "txn_id", "amount", "city"]
    assert dict((r["city"], r["count"]) for r in got.groupBy("city").count().collect()) == {"Pune": 3990, "Delhi": 10}
    outer = joined._met(rows.limit(0), "txn_id", dim, "account_id", 8, busy=busy)
    assert outer.count() == 0 and "explode" in got._jdf.queryExecution().analyzed().toString()


def test_joins_with_busy_accounts_follow_versions(spark, scratch):
    put(spark, scratch, "transaction", "1", wire(spark, "transaction", [txn(f"t{k}", f"a{k % 2}", 60_000.0) for k in range(6)]))
    put(spark, scratch, "account", "1", wire(spark, "account", [account("a0", "c1", "b1"), account("a1", "c1", "b1")]))
    put(spark, scratch, "branch", "1", wire(spark, "branch", [branch("b1", "Pune")]))
    busy = spark.createDataFrame([("a0",)], "account_id string")
    assert run_join(spark, scratch, busy=busy) == {f"t{k}": "Pune" for k in range(6)}
    put(spark, scratch, "branch", "2", wire(spark, "branch", [branch("b1", "Goa")]), 2)
    assert set(run_join(spark, scratch, busy=busy).values()) == {"Goa"}
