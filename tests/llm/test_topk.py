from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from bankroll.llm import pivot_topk as P

NO = 1 << 62


def brute(rows, is_query, k=5):
    v = {}
    kept = []
    for i, x in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(256 * c) for c in x]))
    out = set()
    for i, q in kept:
        if i is not None and is_query(i):
            found = sorted((-sum(a * b for a, b in zip(q, x)), j if j is not None else NO)
                           for j, x in kept if j != i and len(x) == len(q))[:k]
            out |= {(i, r + 1, None if j == NO else j, -s) for r, (s, j) in enumerate(found)}
    return out


def rows_of(lm, n=400, dim=12, seed=3):
    r = random.Random(seed)
    rows = [(k, [r.gauss(0, 0.3) for _ in range(dim)]) for k in range(n)]
    rows += [(k + n, list(rows[k % 7][1])) for k in range(30)]            # ties
    rows += [(2000, None), (2050, [float("nan")] * dim), (2100, [None] + [0.1] * (dim - 1)),
             (2150, [float("inf")] * dim), (None, [0.2] * dim), (50, rows[50][1]), (2200, [1.0, 2.0]),
             (2250, [3.0, 4.0]), (2300, []), (2301, [])]
    return rows


def got(df):
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()]


def test_equals_brute_force(lm, monkeypatch):
    rows = rows_of(lm)
    df = lm.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    found = got(P.top_k(df, F.col("id") % 50 == 0))
    assert len(found) == len(set(found)) and set(found) == want
    monkeypatch.setattr(P, "BLOCK_ROWS", 37)
    monkeypatch.setattr(P, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(P, "EVALUATED_AT_ONCE", 4)
    assert set(got(P.top_k(df.repartition(3), F.col("id") % 50 == 0))) == want


def test_pivots_spare_candidates(lm):
    """In clustered data the bounds end the search early."""
    import numpy as np
    import pyarrow as pa

    r = np.random.default_rng(1)
    x = np.floor(np.repeat(r.normal(0, 200, (20, 16)), 100, axis=0) + r.normal(0, 2, (2000, 16)))
    own = P._to_pivots(x)
    t = pa.table({"id": pa.array(np.arange(2000)), "v": pa.array(list(x)), "dim": pa.array([16] * 2000, pa.int32()),
                  "pivot_distances": pa.array(list(own))})
    out = P._best(5)(t.slice(0, 10), t)
    assert max(out["evaluated"].to_pylist()) < 2000


def test_fewer_candidates_than_k_and_empty(lm):
    df = lm.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<float>")
    assert got(P.top_k(df, F.col("id") % 50 == 0)) == [(0, 1, 1, 32768)]
    assert got(P.top_k(df.limit(0), F.col("id") % 50 == 0)) == []
