"""Records of several schema versions: resolution, quarantine, replay."""
from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from bankroll.sources.records import wire_schema
from bankroll.sources.versions import Versions, parse_versions, replay

IDS = {"txn_id": "a" * 32, "account_id": "b" * 32, "product_id": "c" * 32}
FULL = {**IDS, "txn_type": "Deposit", "amount": 12.5, "currency": "INR", "txn_time": 1_700_000_000_000,
        "channel": "Digital", "status": "approved", "approved_by_emp_id": None}
CURRENT = wire_schema("transaction")


def without(*names, **changed):
    """The contract's wire schema without some fields, others with another type or name."""
    fields = []
    for f in CURRENT:
        name, kind = changed.get(f.name, (f.name, f.dataType))
        if f.name not in names:
            fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def messages(spark, *rows):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v), n) for v, n in rows],
                                 "value string, schema_id int")


def test_added_dropped_renamed_and_promoted_fields(spark):
    versions = Versions("transaction", {
        1: without("approved_by_emp_id", "channel", amount=("amount", T.IntegerType())),
        2: T.StructType([*without(currency=("ccy", T.StringType())), T.StructField("device", T.StringType())]),
        3: CURRENT}, defaults={"channel": "Branch"}, aliases={"currency": ("ccy", "curr")})
    assert versions.readable() == [1, 2, 3]
    old = {k: v for k, v in FULL.items() if k not in ("approved_by_emp_id", "channel")} | {"amount": 7}
    renamed = {k: v for k, v in FULL.items() if k != "currency"} | {"ccy": "EUR", "device": "x"}
    good, bad = parse_versions(messages(spark, (old, 1), (renamed, 2), (FULL, 3), (FULL, 3)), versions)
    got = sorted((r.schema_id, r.amount, r.currency, r.channel, r.approved_by_emp_id) for r in good.collect())
    assert got == [(1, 7.0, "INR", "Branch", None), (2, 12.5, "EUR", "Digital", None),
                   (3, 12.5, "INR", "Digital", None), (3, 12.5, "INR", "Digital", None)]
    assert bad.count() == 0 and dict(good.dtypes)["amount"] == "double"


def test_versions_that_cannot_be_read(spark):
    versions = Versions("transaction", {1: without("channel"), 2: without(amount=("amount", T.StringType())), 3: CURRENT})
    assert versions.problems(1) == ["no default for channel"]
    assert versions.problems(2) == ["amount is string, not double"]
    assert versions.readable() == [3]
    sent = messages(spark, (FULL, 1), (FULL, 2), (FULL, 3), (FULL, 9), (FULL, None), (None, 3), ("{", 3), ("", 3))
    good, bad = parse_versions(sent, versions)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == [
        "incompatible version 1: no default for channel", "incompatible version 2: amount is string, not double",
        "no schema version", "unknown version 9", "unparseable record", "unparseable record", "unparseable record"]
    with pytest.raises(ValueError):
        Versions("transaction", {}, defaults={"colour": "red"})


def test_enumerations_and_replay(spark):
    versions = Versions("transaction", {3: CURRENT})
    sent = messages(spark, ({**FULL, "channel": "Kiosk"}, 3), ({**FULL, "status": "Held"}, 3),
                    ({**FULL, "channel": None}, 3), (FULL, 4))
    good, bad = parse_versions(sent, versions)
    assert good.count() == 0
    assert sorted(r.reason for r in bad.collect()) == [
        "null channel", "unknown channel Kiosk", "unknown status Held", "unknown version 4"]
    assert bad.columns == ["value", "schema_id", "reason"]
    later = versions.adding(writers={4: CURRENT}, enum_defaults={"channel": "Branch"})
    again, stay = replay(bad, later)
    assert sorted((r.schema_id, r.channel) for r in again.collect()) == [(3, "Branch"), (4, "Digital")]
    assert sorted(r.reason for r in stay.collect()) == ["null channel", "unknown status Held"]


def test_empty_tables_and_clashing_columns(spark):
    versions = Versions("transaction", {3: CURRENT})
    clash = messages(spark, (FULL, 3), ("no", 3)).selectExpr(
        "value", "schema_id", "'k' as amount", "1 as __row", "2 as `a.b`", "'r' as __found")
    good, bad = parse_versions(clash, versions)
    assert good.first().amount == 12.5
    assert bad.first().asDict() == {"value": "no", "schema_id": 3, "amount": "k", "__row": 1, "a.b": 2,
                                    "__found": "r", "reason": "unparseable record"}
    good, bad = parse_versions(clash.limit(0), versions)
    assert good.count() == 0 and bad.count() == 0
    good, bad = parse_versions(clash, Versions("transaction", {}))
    assert good.count() == 0 and {r.reason for r in bad.collect()} == {"unknown version 3"}
