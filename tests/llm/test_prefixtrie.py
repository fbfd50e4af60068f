from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankroll.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes as a dictionary of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, mark), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        leaves, saved = (0, 0) if children[node] else (1, 0)
        for k in children[node]:
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)

    out = []
    for node, convs in members.items():
        leaves, saved = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == node)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def made(seed, convs, turns, words):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(convs):
        for k in range(int(rng.integers(0, turns))):
            rows.append((int(c * 7 % 211), k, ["user", "assistant"][k % 2], str(rng.choice(words))))
    return rows


def odd():
    return [(None, 1, "user", "of no conversation"), (5, None, None, None), (5, 1, "user", None), (5, 1, "user", None),
            (-3, 0, "user", "below zero"), (-103, 0, "user", "y" * 300_000), (-100, 2, "a", "é🎉"), (-100, 1, "", "a"),
            (8, 3, "ab", "c"), (9, 3, "a", "bc"), (10**15, 0, "user", "far")]


@pytest.mark.parametrize("rows", [
    made(1, 200, 9, ["a", "b"]) + odd(),
    made(2, 60, 40, ["x"] * 30 + ["y"]) + [(1000 + c, k, "u", "same") for c in range(400) for k in range(c % 13)]],
    ids=["short", "deep"])
def test_equals_plain_trie(lm, rows):
    docs = lm.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(1)).withColumn("x", F.lit(2))
    assert got(P.trie(docs)) == brute(rows)


def test_over_conversations(lm, monkeypatch):
    """The given table; without broadcasts, and with small chunks of ids."""
    docs = lm.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = brute([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])
    assert got(P.trie(docs)) == want
    monkeypatch.setattr(P, "CHUNK_BYTES", 16)
    monkeypatch.setattr(P, "PROBES_A_PLAN", 1)
    lm.conf.set("bankroll.broadcast.maxRows", "0")
    try:
        assert got(P.trie(docs)) == want
    finally:
        lm.conf.unset("bankroll.broadcast.maxRows")


def test_empty(lm):
    assert P.trie(lm.createDataFrame([(None, 0, "u", "t")], SCHEMA)).collect() == []


def test_two_fattest(lm):
    rows = lm.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 41)], "a long, b long")
    zeros = lambda x: (x & -x).bit_length()
    for r in rows.withColumn("f", P.two_fattest(F.col("a"), F.col("b"))).collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=zeros)


def test_hashes_of_many_ends(lm):
    """One end with very many ids: chunks over several ranges."""
    ends = lm.range(50_000).select(F.col("id").alias("conv"), F.when(F.col("id") % 3 < 2, 4).otherwise(F.col("id") % 5).cast("long").alias("size"),
                                   F.lit(1).cast("long").alias("s1"), F.lit(2).cast("long").alias("s2"))
    want = defaultdict(list)
    for r in ends.collect():
        want[r["size"]].append(r.conv)
    got = {r["size"]: r.ends_sha256 for r in P.end_hashes(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
