"""Stream refresh equals the batch rollups (landed mode and stream-static mode)."""
from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from bankroll.catalog import present
from bankroll.plans import rollups as R
from bankroll.sources import records, testdata
from bankroll.streaming import stream_static
from bankroll.streaming.landed import LandedRefresh
from fixtures import SF_SMALL
from helpers import multiset, spark_rows

ID_COLS = {"branch_id", "customer_id", "emp_id", "manager_id", "account_id", "product_id",
           "txn_id", "approved_by_emp_id", "employee_id"}


def as_text_ids(df):
    return df.select(*[F.col(c).cast("string").alias(c) if c in ID_COLS else F.col(c)
                       for c in df.columns])


def same(a, b):
    a, b = present(as_text_ids(a)), present(as_text_ids(b))
    c1, r1 = spark_rows(a)
    c2, r2 = spark_rows(b.select(*a.columns))
    m1, m2 = multiset(c1, r1), multiset(c2, r2)
    assert m1 == m2, (list((m1 - m2).items())[:3], list((m2 - m1).items())[:3])


def write_wire(df, table, path, files=1, seq=0):
    wire = records.encode(df, table).withColumn("seq", F.lit(seq).cast("long"))
    wire.repartition(files).write.mode("append").json(path)


def write_rows(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


@pytest.fixture(scope="module")
def base(spark):
    t = testdata.tables(spark, SF_SMALL)
    # the test tables lack two required contract columns; give them a fixed value
    return {"transaction": t["transaction"],
            "account": t["account"].withColumn("account_type", F.lit("Savings")),
            "branch": t["branch"],
            "employee": t["employee"].withColumn("hire_date", F.lit("2015-01-01").cast("date"))}


def run(refresh, src, ckpt):
    q = refresh.start(src, ckpt, max_files_per_trigger=1, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None


def test_landed_stream_equals_batch_with_early_transactions(spark, base, scratch):
    src = {k: f"{scratch}/src/{k}" for k in ("transaction", "account", "branch", "employee")}
    write_wire(base["transaction"], "transaction", src["transaction"], files=3)
    for k in ("account", "branch", "employee"):
        os.makedirs(src[k], exist_ok=True)
    ref = LandedRefresh(spark, f"{scratch}/state", check_ids=False)
    run(ref, src, f"{scratch}/ckpt")                       # transactions only: nothing joins yet
    assert ref.read_view("q6").count() == 0
    assert ref.read_view("q1").count() == base["transaction"].count()
    for k in ("account", "branch", "employee"):           # dimensions arrive afterwards
        write_wire(base[k], k, src[k])
    run(ref, src, f"{scratch}/ckpt")
    for name in ("q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q6"):
        same(R.ROLLUPS[name](base), ref.read_view(name))
    same(R.q5_high_value_customers(base, 5, 300_000),
         R.q5_high_value_customers({}, 5, 300_000, q5a=ref.read_view("q5a"), q5b=ref.read_view("q5b")))

    # a branch moves city: its old city's groups shrink or vanish, the new city's grow
    b = base["branch"].filter(F.col("branch_id") == 3)
    moved = b.withColumn("city", F.lit("ATLANTIS"))
    write_wire(moved, "branch", src["branch"], seq=1)
    run(ref, src, f"{scratch}/ckpt")
    changed = dict(base, branch=base["branch"].filter(F.col("branch_id") != 3).unionByName(moved))
    for name in ("q3", "q3r", "q4"):
        same(R.ROLLUPS[name](changed), ref.read_view(name))
    assert ref.read_view("q3").filter(F.col("city") == "ATLANTIS").count() > 0


def _dims(spark, scratch):
    src = {k: f"{scratch}/src/{k}" for k in ("transaction", "account", "branch", "employee")}
    write_rows(src["branch"], "b0.json", [
        {"branch_id": "b1", "branch_name": "Pune Main", "city": "Pune", "region": "West", "seq": 0},
        {"branch_id": "b2", "branch_name": "Delhi Main", "city": "Delhi", "region": "North", "seq": 0}])
    write_rows(src["employee"], "e0.json", [
        {"emp_id": "e1", "name": "A", "role": "Manager", "branch_id": "b1", "manager_id": None,
         "hire_date": "2015-01-01", "seq": 0}])
    write_rows(src["account"], "a0.json", [
        {"account_id": f"a{i}", "customer_id": "c1", "account_type": "Savings", "status": "Active",
         "branch_id": "b1", "opened_at": "2020-01-01T00:00:00+00:00", "closed_at": None, "seq": 0}
        for i in range(7)])
    return src


def _txn(i, account="a0", amount=60000.0, ms=1736935200000, **kw):
    r = {"txn_id": f"t{i}", "account_id": account, "txn_type": "Withdrawal", "amount": amount,
         "currency": "INR", "txn_time": ms, "channel": "Digital", "status": "approved",
         "product_id": "p1", "approved_by_emp_id": "e1", "seq": 0}
    r.update(kw)
    return r


@pytest.mark.parametrize("snapshot_every", [0, 1])
def test_landed_revisions_redelivery_and_versions(spark, scratch, snapshot_every):
    src = _dims(spark, scratch)
    write_rows(src["transaction"], "t0.json", [_txn(1), _txn(2, account="a1", amount=400000.0),
                                              _txn(3, account="a9")])      # a9 not known yet
    ref = LandedRefresh(spark, f"{scratch}/state", snapshot_every=snapshot_every, check_ids=False)
    run(ref, src, f"{scratch}/ckpt")
    assert sorted(r.txn_count for r in ref.read_view("q3").collect()) == [2]
    assert ref.read_view("q5a").first().account_count == 7
    # re-delivery of t1, a9 arrives (owned by c2), two versions of a2 in one file (seq wins),
    # account a3 closes
    write_rows(src["transaction"], "t1.json", [_txn(1)])
    write_rows(src["account"], "a1.json", [
        {"account_id": "a9", "customer_id": "c2", "account_type": "Savings", "status": "Active",
         "branch_id": "b2", "opened_at": "2021-01-01T00:00:00+00:00", "closed_at": None, "seq": 1},
        {"account_id": "a2", "customer_id": "c1", "account_type": "Savings", "status": "Frozen",
         "branch_id": "b1", "opened_at": "2020-01-01T00:00:00+00:00", "closed_at": None, "seq": 2},
        {"account_id": "a2", "customer_id": "c1", "account_type": "Savings", "status": "Inactive",
         "branch_id": "b1", "opened_at": "2020-01-01T00:00:00+00:00",
         "closed_at": "2024-01-01T00:00:00.000+00:00", "seq": 1},
        {"account_id": "a3", "customer_id": "c1", "account_type": "Savings", "status": "Inactive",
         "branch_id": "b1", "opened_at": "2020-01-01T00:00:00+00:00",
         "closed_at": "2024-01-01T00:00:00+00:00", "seq": 1}])
    run(ref, src, f"{scratch}/ckpt")
    q3 = sorted((r.city, r.txn_count) for r in ref.read_view("q3").collect())
    assert q3 == [("Delhi", 1), ("Pune", 2)]                  # t1 counted once; a9 joined
    counts = {r.customer_id: r.account_count for r in ref.read_view("q5a").collect()}
    assert counts == {"c1": 5, "c2": 1}                       # a2 Frozen (seq 2), a3 closed
    q5b = {(r.customer_id, r.quarter): r.amount for r in ref.read_view("q5b").collect()}
    assert q5b == {("c1", "2025Q1"): 460000.0, ("c2", "2025Q1"): 60000.0}
    # account a1 moves to customer c2: Q5b moves with it
    write_rows(src["account"], "a2.json", [
        {"account_id": "a1", "customer_id": "c2", "account_type": "Savings", "status": "Active",
         "branch_id": "b1", "opened_at": "2020-01-01T00:00:00+00:00", "closed_at": None, "seq": 3}])
    run(ref, src, f"{scratch}/ckpt")
    q5b = {(r.customer_id, r.quarter): r.amount for r in ref.read_view("q5b").collect()}
    assert q5b == {("c1", "2025Q1"): 60000.0, ("c2", "2025Q1"): 460000.0}
    counts = {r.customer_id: r.account_count for r in ref.read_view("q5a").collect()}
    assert counts == {"c1": 4, "c2": 2}
    # Q5 with its default bounds: c1 has 4 active accounts -> nothing
    assert ref.read_view("q5").count() == 0
    # a restarted process reads the same state (snapshots and marks from storage)
    again = LandedRefresh(spark, f"{scratch}/state", snapshot_every=snapshot_every, check_ids=False)
    for name in ("q5b", "q3", "q5a"):
        assert sorted(map(tuple, again.read_view(name).collect())) == \
            sorted(map(tuple, ref.read_view(name).collect()))
    if snapshot_every:
        assert again._snapshots("results", "q5b") == [0, 1]


def test_landed_replay_is_idempotent(spark, base, scratch):
    ref = LandedRefresh(spark, f"{scratch}/state", check_ids=False)
    wire = {k: records.encode(base[k], k).withColumn("seq", F.lit(0).cast("long"))
            for k in ("transaction", "account", "branch", "employee")}
    from bankroll.streaming.sources import tagged_union

    batch = tagged_union(wire)
    ref.process_batch(batch, 0)
    first = {n: ref.read_view(n).count() for n in ("q3", "q6", "q5b")}
    ref.process_batch(batch, 0)        # the same batch again, as after a crash before commit
    again = {n: ref.read_view(n).count() for n in ("q3", "q6", "q5b")}
    assert first == again
    same(R.q6_branch_daily(base), ref.read_view("q6"))


@pytest.mark.parametrize("name", ["q1", "q3", "q4", "q5b", "q6"])
def test_stream_static_equals_batch(spark, base, scratch, name):
    path = f"{scratch}/src/transaction"
    write_wire(base["transaction"], "transaction", path, files=3)
    from bankroll.streaming.sources import read_stream

    dims = {k: as_text_ids(base[k]) for k in ("account", "branch", "employee")}
    wire = read_stream(spark, path, "transaction", max_files_per_trigger=1)
    q = stream_static.start(name, wire, dims, f"{scratch}/out", f"{scratch}/ckpt", available_now=True,
                            watermark=None)
    q.awaitTermination(600)
    assert q.exception() is None
    same(R.ROLLUPS[name](base), stream_static.read_view(spark, name, f"{scratch}/out"))


def test_stream_static_drops_late_rows_when_asked(spark, scratch):
    src = f"{scratch}/src"
    day = 86_400_000
    write_rows(src, "0.json", [_txn(1, ms=10 * day)])
    from bankroll.streaming.sources import read_stream
    from pyspark.sql import Row

    dims = {"account": spark.createDataFrame([Row(account_id="a0", branch_id="b1", customer_id="c1")]),
            "branch": spark.createDataFrame([Row(branch_id="b1", city="Pune")])}
    ckpt, out = f"{scratch}/ckpt", f"{scratch}/out"

    def go():
        q = stream_static.start("q3", read_stream(spark, src, "transaction"), dims, out, ckpt,
                                available_now=True, drop_late=True)
        q.awaitTermination(600)
        return q

    go()
    write_rows(src, "1.json", [_txn(2, ms=day)])           # 9 days late: behind the watermark
    go()
    write_rows(src, "2.json", [_txn(3, ms=2 * day)])       # later batch: dropped from now on
    go()
    counts = {r.window_start.date().day: r.txn_count
              for r in stream_static.read_view(spark, "q3", out).collect()}
    assert counts.get(11) == 1 and 3 not in counts


def test_stream_static_dedupe_option(spark, scratch):
    """T9 option: a re-delivered transaction inside the watermark counts once."""
    src = f"{scratch}/src"
    write_rows(src, "0.json", [_txn(1, amount=100.0)])
    write_rows(src, "1.json", [_txn(1, amount=100.0), _txn(2, amount=5.0)])
    from bankroll.streaming.sources import read_stream
    from pyspark.sql import Row

    dims = {"account": spark.createDataFrame([Row(account_id="a0", branch_id="b1", customer_id="c1")])}
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    q = stream_static.start("q6", read_stream(spark, src, "transaction", max_files_per_trigger=1),
                            dims, out, ckpt, available_now=True, dedupe=True)
    q.awaitTermination(600)
    row = stream_static.read_view(spark, "q6", out).first()
    assert (row.count_txn, row.total_amount) == (2, 105.0)


def test_latest_by_key_on_a_stream(spark, scratch):
    """T7 on a stream: the compacted view of a changelog, kept by a streaming aggregation."""
    from bankroll.operators.compaction import latest_by_key
    from bankroll.streaming.sources import read_stream

    src = f"{scratch}/branch"
    write_rows(src, "0.json", [{"branch_id": "b1", "branch_name": "P", "city": "Pune", "region": "W", "seq": 1},
                               {"branch_id": "b2", "branch_name": "D", "city": "Delhi", "region": "N", "seq": 1}])
    write_rows(src, "1.json", [{"branch_id": "b1", "branch_name": "P", "city": "Mumbai", "region": "W", "seq": 2}])
    out = f"{scratch}/out"

    def write(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    view = latest_by_key(read_stream(spark, src, "branch", max_files_per_trigger=1), "branch_id", "seq")
    q = (view.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = latest_by_key(spark.read.parquet(out), "branch_id", "batch_id")
    assert sorted((r.branch_id, r.city) for r in got.collect()) == [("b1", "Mumbai"), ("b2", "Delhi")]


def test_read_view_before_first_write_is_empty(spark, scratch):
    ref = LandedRefresh(spark, f"{scratch}/state", check_ids=False)
    v = ref.read_view("q6")
    assert v.count() == 0
    assert v.columns == ["branch_id", "txn_year", "txn_date", "total_amount", "count_txn"]


def test_corrected_time_in_another_quarter_leaves_one_group(spark, scratch):
    """A transaction re-delivered with another time moves; its old groups vanish, and stay so
    when a later batch touches the old month."""
    src = _dims(spark, scratch)
    april = 1744711200000
    ref = LandedRefresh(spark, f"{scratch}/state", results=("q5b", "q1"), snapshot_every=1, check_ids=False)
    write_rows(src["transaction"], "t0.json", [_txn(1, amount=100.0)])
    run(ref, src, f"{scratch}/ckpt")
    write_rows(src["transaction"], "t1.json", [_txn(1, amount=100.0, ms=april, seq=1)])
    run(ref, src, f"{scratch}/ckpt")

    def q5b():
        return {(r.customer_id, r.quarter): r.amount for r in ref.read_view("q5b").collect()}

    assert q5b() == {("c1", "2025Q2"): 100.0}
    assert ref.read_view("q1").count() == 1
    for k in (2, 3):  # the old month again, over a snapshot
        write_rows(src["transaction"], f"t{k}.json", [_txn(k, amount=1.0)])
        run(ref, src, f"{scratch}/ckpt")
    assert q5b() == {("c1", "2025Q1"): 2.0, ("c1", "2025Q2"): 100.0}
    # and back again
    write_rows(src["transaction"], "t9.json", [_txn(1, amount=100.0, seq=2)])
    run(ref, src, f"{scratch}/ckpt")
    assert q5b() == {("c1", "2025Q1"): 102.0}


def _files(df) -> list[str]:
    return df.inputFiles()


def test_a_batch_reads_its_own_months_only(spark, scratch):
    """Files read for a one-row batch do not grow with the history: its month's newest
    snapshot and at most 2 * snapshot_every batches after it."""
    src = _dims(spark, scratch)
    month = 31 * 86_400_000
    ref = LandedRefresh(spark, f"{scratch}/state", results=("q1",), snapshot_every=1, check_ids=False)
    for k in range(5):
        write_rows(src["transaction"], f"t{k}.json", [_txn(k, ms=1736935200000 + (k % 2) * 3 * month)])
        run(ref, src, f"{scratch}/ckpt")
    january = ref._txns(["202501"], 4)
    assert january.filter("txn_month <> '202501'").count() == 0
    read = [f for f in _files(january) if "txn_month=202501" in f]
    snaps = {f.split("upto=")[1].split("/")[0] for f in read if "/snap/" in f}
    assert len(snaps) == 1
    batches = {f.split("batch_id=")[1].split("/")[0] for f in read if "/land/" in f}
    used = {b for b in batches if int(b) > int(next(iter(snaps)))}
    assert len(used) <= 2 * ref.snapshot_every
    # an account that has no transactions yet leads to no month
    ids = spark.createDataFrame([("a-new",)], "account_id string")
    assert ref._months_of("account", ids, 4) == []
    assert ref._revisited("account", ids, 4) is None
    assert ref._months_of("account", spark.createDataFrame([("a0",)], "account_id string"), 4) == ["202501", "202504"]


def test_errors_are_raised_and_columns_keep_their_order(spark, scratch):
    from pyspark.errors import AnalysisException

    src = _dims(spark, scratch)
    ref = LandedRefresh(spark, f"{scratch}/state", results=("q6",), check_ids=False)
    before = ref.read_view("q6").columns
    write_rows(src["transaction"], "t0.json", [_txn(1)])
    run(ref, src, f"{scratch}/ckpt")
    assert ref.read_view("q6").columns == before
    with pytest.raises(AnalysisException):
        LandedRefresh(spark, "nofs://nowhere")._exists("not-a-scheme:::/x")


def test_latest_by_key_aggregates_by_hash(spark):
    from bankroll.operators.compaction import latest_by_key

    df = spark.range(100).selectExpr("id % 7 as k", "id as v", "cast(id as string) as s")
    out = latest_by_key(df, "k", ["v", "s"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan and "functions=[partial_max(v" in plan
    assert "LeftSemi" in plan and "ShuffledHashJoin" in plan
    assert sorted((r.k, r.v) for r in out.collect()) == sorted((k, max(v for v in range(100) if v % 7 == k)) for k in range(7))
