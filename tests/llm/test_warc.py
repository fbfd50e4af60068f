from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from bankroll.llm import warc


def captures(lm):
    rows = [(None, None, None), (5, "http://www.B.com/x?q=1#f", "same"), (9, "http://b.com/x?q=1", "same"),
            (7, "https://a.com/", "same"), (1, "u", ""), (2, "", None), (3, "http://x/ü y\n", "\r\n\r\nWARC/1.1\r\n\r\n"),
            (4, "http://x/ü", "\r\n\r\nWARC/1.1\r\n\r\n"), (8, "http://[bad", "é" * 50_000)]
    rows += [(100 + k, f"http://h{k % 7}.org/p{k % 3}", f"page {k % 20}") for k in range(200)]
    df = lm.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    return df.withColumn("captured_at", F.timestamp_seconds(F.col("page_id") % 13)), rows


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows):
    most = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if key is not None:
            most[body] = max(most.get(body, key), key)
    out = Counter()
    for key, _, html in rows:
        body = (html or "").encode()
        revisit = body in most and key != most[body]
        out["" if key is None else str(key), len(body), digest(body), "revisit" if revisit else "response",
            str(most[body]) if revisit else None] += 1
    return out


def got(index):
    return Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index)


def test_round_trip_and_global_order(lm, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    df, rows = captures(lm)
    index = sorted(warc.archive_and_index(df).collect(), key=lambda r: (r.key_range, r.place))
    assert got(index) == expected(rows)
    keys = [(r.urlkey.encode(), r.captured_at, r.key) for r in index]
    assert keys == sorted(keys) and len({r.key_range for r in index}) > 1


def test_shuffled_decisions_give_the_same(lm, monkeypatch):
    monkeypatch.setattr(warc, "REVISITS_BROADCAST", 0)
    df, rows = captures(lm)
    assert got(warc.archive_and_index(df).collect()) == expected(rows)


def test_url_key():
    assert warc.url_key("https://www.Example.com/A?b=C#d") == "com,example)/a?b=c"
    assert warc.url_key("http://a.b.c") == "c,b,a)/"


def test_loser_tree_merges_runs():
    r = random.Random(3)
    for n in (0, 1, 2, 3, 7, 8, 20):
        runs = [sorted(r.choices(range(30), k=r.randrange(0, 12))) for _ in range(n)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_empty_table(lm):
    df, _ = captures(lm)
    assert warc.archive_and_index(df.filter("page_id < -5")).count() == 0
