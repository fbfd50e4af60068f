"""Wire encoding, keyed emission, decoding with quarantine, compaction."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bankroll.functions import buckets as B
from bankroll.operators.compaction import latest_by_key
from bankroll.sources import records
from fixtures import frame, ts, txn

UUID1 = "0b6c2f8e-5a4f-4f3b-9a51-2f7a3c9d1e11"


def customer_row(cid=UUID1, created="2024-02-03T04:05:06.789Z"):
    return {"customer_id": cid, "name": "Uma Rao", "dob": dt.date(1980, 5, 6),
            "customer_segment": "HNI", "pan_hash": "ABCDEF0123456789", "city": "Pune",
            "created_at": ts(created) if created else None}


def test_iso_utc_text_matches_isoformat(spark):
    df = spark.createDataFrame([(ts("2024-02-03T04:05:06.789Z"),), (ts("2024-02-03T04:05:06Z"),),
                                (None,)], "t timestamp")
    got = [r[0] for r in df.select(B.iso_utc_text("t")).collect()]
    want = [ts("2024-02-03T04:05:06.789Z").isoformat(), ts("2024-02-03T04:05:06Z").isoformat(), None]
    assert got == want
    d = spark.createDataFrame([(dt.date(2024, 2, 3),)], "d date")
    assert d.select(B.iso_utc_text("d")).first()[0] == "2024-02-03T00:00:00+00:00"


def test_dimension_round_trip_and_quarantine(spark):
    good_rows = [customer_row(), customer_row(cid="1b6c2f8e5a4f4f3b9a512f7a3c9d1e11", created=None)]
    df = frame(spark, "customer", good_rows)
    wire = records.encode(df, "customer")
    assert wire.first().dob == "1980-05-06"
    back, bad = records.decode(wire, "customer", check_ids=True)
    assert bad.count() == 0
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))

    broken = wire.union(spark.createDataFrame(
        [("not-a-uuid", "X", "2024-13-01", "HNI", "P", "Pune", "2024-13-01T00:00:00Z")],
        wire.schema))
    good, bad = records.decode(broken, "customer", check_ids=True)
    assert good.count() == 2
    reasons = bad.first().reason
    assert "bad id customer_id" in reasons and "bad time dob" in reasons and "bad time created_at" in reasons



def test_uuid_validation(spark):
    vals = [UUID1, UUID1.upper(), UUID1.replace("-", ""), "{" + UUID1 + "}", "urn:uuid:" + UUID1,
            "not-a-uuid", "12345", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(B.uuid_is_valid("v")).collect()]
    assert got == [True, True, True, True, True, False, False, True]


def test_keyed_emission_and_parse(spark):
    df = frame(spark, "transaction", [txn("t1", account_id="acc-9", approver=None)])
    msgs = records.emit_keyed(df, "transaction")
    m = msgs.first()
    assert (m.topic, m.key) == ("banking.transactions", "acc-9")
    assert '"approved_by_emp_id":null' in m.value and '"txn_time":1736935200000' in m.value
    junk = spark.createDataFrame([("banking.transactions", "k", "{not json")], msgs.schema)
    good, bad = records.parse_keyed(msgs.unionByName(junk), "transaction", check_ids=False)
    assert [tuple(r) for r in good.collect()] == [tuple(r) for r in df.collect()]
    assert [tuple(r) for r in bad.collect()] == [("{not json", "unparseable record")]


def test_ids_are_checked_unless_told_otherwise(spark):
    df = frame(spark, "transaction", [txn("t1", account_id="acc-9")])
    good, bad = records.parse_keyed(records.emit_keyed(df, "transaction"), "transaction")
    assert good.count() == 0 and "bad id account_id" in bad.first().reason
    good, bad = records.decode(records.encode(df, "transaction"), "transaction")
    assert good.count() == 0 and bad.count() == 1


def test_null_and_mistyped_values_keep_their_text(spark):
    rows = [("t", "k", None), ("t", "k", '{"amount":"much"}'), ("t", "k", "[]")]
    msgs = spark.createDataFrame(rows, "topic string, key string, value string")
    good, bad = records.parse_keyed(msgs, "transaction")
    assert good.count() == 0
    assert sorted((r.value or "") for r in bad.collect()) == sorted((v or "") for _, _, v in rows)


def test_malformed_lines_of_a_stream_are_quarantined(spark, scratch):
    import os

    from bankroll.streaming.landed import LandedRefresh

    src = f"{scratch}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write("{not json\n")
    ref = LandedRefresh(spark, f"{scratch}/state", results=("q1",))
    query = ref.start({"transaction": src}, f"{scratch}/ckpt", available_now=True)
    query.awaitTermination(600)
    bad = spark.read.parquet(f"{scratch}/state/quarantine/transaction").collect()
    assert [(r._corrupt_record, r.reason) for r in bad] == [("{not json", "unparseable record")]
    assert ref.read_view("q1").count() == 0


def test_pan_hash(spark):
    import hashlib

    want = hashlib.sha256(b"PAN-42").hexdigest()[:16].upper()
    assert spark.range(1).select(B.pan_hash(F.lit(42))).first()[0] == want


def test_clamp_round(spark):
    df = spark.createDataFrame([(0.2,), (123.456,), (200000.0,)], "x double")
    assert [r[0] for r in df.select(B.clamp_round("x", 1.0, 150000.0)).collect()] == [1.0, 123.46, 150000.0]


def test_latest_by_key_two_versions_same_batch(spark):
    df = spark.createDataFrame(
        [("k1", 1, 1, "old"), ("k1", 1, 2, "new"), ("k2", 0, 5, "only"), ("k3", 2, 1, "gone")],
        "key string, batch_id int, seq int, v string")
    out = latest_by_key(df.withColumn("deleted", F.col("v") == "gone"), "key", ["batch_id", "seq"],
                        drop_deleted="deleted")
    assert sorted((r.key, r.v) for r in out.collect()) == [("k1", "new"), ("k2", "only")]


def test_typed_scan_reads_contract_order(spark, scratch):
    df = frame(spark, "transaction", [txn("t1")])
    df.select(*reversed(df.columns)).write.mode("overwrite").json(f"{scratch}/t")
    back = records.read_table(spark, f"{scratch}/t", "transaction", fmt="json")
    assert back.columns == df.columns and back.count() == 1


def test_a_message_is_parsed_once(spark):
    """a parse per field and check made the parsing of a message cost hundreds of parses."""
    sent = spark.createDataFrame([("{}",)], "value string").withColumn(
        "value", F.concat(F.lit("{"), F.sha2("value", 256), F.lit("}")))
    for df in records.parse_keyed(sent, "transaction"):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("sha2(") == 1
