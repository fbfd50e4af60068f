"""Intake of transactions: kept + late + quarantined = sent, whatever is replayed."""
from __future__ import annotations

import json

from bankroll.sources.records import encode
from bankroll.streaming import intake
from bankroll.streaming.sources import changelog_schema, read_stream
from fixtures import frame, txn


def _send(spark, path, rows, broken=()):
    wire = [r.asDict() for r in encode(frame(spark, "transaction", rows), "transaction").collect()]
    lines = [json.dumps({**r, "seq": 0}) for r in wire] + list(broken)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def _run(spark, src, out):
    q = intake.start(read_stream(spark, src, "transaction"), out, delay="1 hour", check_ids=False, available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def _ids(df):
    return sorted(r.txn_id for r in df.collect())


def test_every_line_has_one_place(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    _send(spark, src, [txn("a", when="2025-01-15T10:00:00Z"), txn("b", when="2025-01-10T00:00:00Z")])
    _run(spark, src, out)
    assert _ids(intake.rows(spark, out, "kept")) == ["a", "b"]      # the first batch has no watermark
    _send(spark, src, [txn("c", when="2025-01-15T09:00:00Z"), txn("d", when="2025-01-15T08:59:59Z"),
                       txn("d", when="2025-01-15T08:59:59Z"), txn("e", when="2025-01-15T12:00:00Z")],
          broken=["{", json.dumps({"txn_id": "f"})])
    _run(spark, src, out)
    _send(spark, src, [], broken=["no"])                            # passes the maximum on
    _run(spark, src, out)
    _send(spark, src, [txn("g", when="2025-01-15T10:59:59Z"), txn("h", when="2025-01-15T11:00:00Z")])
    _run(spark, src, out)
    assert _ids(intake.rows(spark, out, "kept")) == ["a", "b", "c", "e", "h"]
    late = intake.rows(spark, out, "late")
    assert _ids(late) == ["d", "d", "g"]
    assert {r.watermark.isoformat()[:19] for r in late.collect()} <= {"2025-01-15T09:00:00", "2025-01-15T11:00:00"}
    bad = intake.quarantined(spark, out)
    assert bad.count() == 3 and bad.filter("reason = 'unparseable record'").count() == 2

    # a replayed batch decides as it did at first, although later ones moved the watermark
    again = spark.read.schema(changelog_schema("transaction")).json(src).filter("txn_id in ('c', 'd', 'e')")
    intake.land(again, 1, out, "1 hour", check_ids=False)
    assert _ids(intake.rows(spark, out, "kept")) == ["a", "b", "c", "e", "h"]
    assert _ids(intake.rows(spark, out, "late")) == ["d", "d", "g"]


def test_nothing_landed_yet(spark, scratch):
    assert intake.rows(spark, f"{scratch}/none", "late").count() == 0
    assert intake.quarantined(spark, f"{scratch}/none").count() == 0
