from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np

from bankroll.llm import shards
from odd import odd_documents


def check(rows, source, n):
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in source)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for s, held in slots.items():
        assert 0 <= s < n and sorted(held) == list(range(len(held)))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    size = Counter()
    for r in rows:
        size[r.shard] += r["size"]
    return [size[s] for s in range(n)]


def test_documents(lm, documents):
    docs = odd_documents(lm, documents)
    rows, source = shards.pack(docs).collect(), docs.collect()
    size = check(rows, source, 8)
    # one text is larger than an eighth of all; the other shards are even
    size.sort()
    assert size[-1] == max(r["size"] for r in rows) and size[-2] <= 1.02 * size[0]
    text = {r.doc_id: r.text for r in source}
    where = defaultdict(set)
    for r in rows:
        where[text[r.doc_id] or ""].add(r.shard)
    assert all(len(s) == 1 for s in where.values())  # no group here is larger than a shard


def test_a_third_of_the_rows_alike(lm, monkeypatch):
    monkeypatch.setattr(shards, "LOT_ROWS", 50)
    rows = [(k, "the same text in very many rows") for k in range(1500)] + [
        (2000 + k, f"text {k} " * (k % 9 + 1)) for k in range(3000)]
    df = lm.createDataFrame(rows, "doc_id long, text string").repartition(6)
    size = check(shards.pack(df).collect(), df.collect(), 8)
    assert max(size) <= 1.01 * min(size)


def test_placing_balances_all_measures():
    r = np.random.default_rng(4)
    items = r.integers(1, 1000, (800, 3)).astype(float)
    where = shards.place(items, 8)
    total = np.array([items[where == s].sum(0) for s in range(8)])
    assert (total.max(0) / total.min(0) < 1.2).all() and total[:, 0].max() / total[:, 0].min() < 1.01


def test_empty_and_single(lm):
    df = lm.createDataFrame([], "doc_id long, text string, shard int, slot int")
    assert shards.pack(df).count() == 0
    one = lm.createDataFrame([(None, None, 3, 4)], df.schema)
    r = shards.pack(one).first()
    assert (r.doc_id, r["size"], r.text_crc32, r.slot) == (None, 1, 0, 0)
