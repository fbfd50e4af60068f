"""Exact top-k search by inner product with a pivot table.

The distances of every vector to a set of pivots are computed once (``pivot_table``). For a
query q and a candidate x, |d(q, p) - d(x, p)| bounds d(q, x) from below for each pivot p;
the largest of these bounds, b, bounds the inner product from above:
q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2 <= (|q|^2 + |x|^2 - b^2) / 2. Candidates are evaluated
in the order of their bounds, some at a time, until the next bound lies below the k-th
score found; those left cannot enter the result, so it is exact.

Work is dealt in blocks: every block of queries meets every block of candidates in one task
of bounded size, which returns its k best for each query; a last step merges these.

Vectors are those of integers floor(256 * x). Cases: vectors that are null, or hold a null
or a component that is not finite, take no part. Vectors of another length than the query's
are no candidates of it. Empty vectors score 0 with each other. A query's own row is every
row with its id; queries with the same id and vector are answered once. Candidate rows that
repeat count each. A null id is no query; as a candidate it comes after all others of its
score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PIVOTS = 24
PIVOT_SEED = 7
SCALE = 256
BLOCK_QUERIES = 2_048
BLOCK_ROWS = 16_384
EVALUATED_AT_ONCE = 256
NO_ID = np.iinfo(np.int64).max


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part; v holds floor(256 * x) as doubles."""
    finite = lambda x: ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"))
            .filter(F.col("raw").isNotNull()
                    & F.forall("raw", lambda x: F.coalesce(finite(x), F.lit(False))))
            .select("id", F.transform("raw", lambda x: F.floor(x.cast("double") * SCALE)
                                      .cast("double")).alias("v"))
            .withColumn("dim", F.size("v")))


def pivots(dim: int) -> np.ndarray:
    """The pivots of a dimension: random directions, the same in every task."""
    return np.random.default_rng([PIVOT_SEED, dim]).normal(0.0, 32.0, (PIVOTS, dim))


def _to_pivots(v: np.ndarray) -> np.ndarray:
    p = pivots(v.shape[1])
    return np.sqrt(np.maximum((v * v).sum(1)[:, None] + (p * p).sum(1) - 2.0 * (v @ p.T), 0.0))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def pivot_table(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``pivot_distances``."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out: list = [None] * batch.num_rows
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                own = _to_pivots(_matrix(batch.column("v").take(pa.array(at)), dim))
                for k, row in zip(at.tolist(), own):
                    out[k] = row
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "v", "dim")), pa.array(out, pa.list_(pa.float64()))],
                ["id", "v", "dim", "pivot_distances"])

    return vectors.mapInArrow(run, "id long, v array<double>, dim int, pivot_distances array<double>")


def _best(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.int64()), "evaluated": pa.array([], pa.int64())})
        if not queries.num_rows or not rows.num_rows:
            return empty
        dim = queries["dim"][0].as_py()
        q, x = _matrix(queries["v"], dim), _matrix(rows["v"], dim)
        dq = _matrix(queries["pivot_distances"], PIVOTS)
        dx = np.ascontiguousarray(_matrix(rows["pivot_distances"], PIVOTS).T)
        ids = rows["id"].fill_null(NO_ID).to_numpy()
        query_ids = queries["id"].to_numpy()
        length = (x * x).sum(1)
        out = []
        for n, own in enumerate(query_ids.tolist()):
            bound = np.zeros(len(x))
            for p in range(PIVOTS):
                np.maximum(bound, np.abs(dx[p] - dq[n, p]), out=bound)
            # rounding of the distances must not cut a candidate off
            bound = np.maximum(bound - 1e-6 * (1.0 + bound), 0.0)
            upper = (length + q[n] @ q[n] - bound * bound) / 2.0
            others = np.flatnonzero(ids != own)
            upper = upper[others] + 1e-6 * (1.0 + np.abs(upper[others]))
            left = np.argsort(-upper, kind="stable")
            score, found, at = np.zeros(0), np.zeros(0, np.int64), 0
            while at < len(left):
                if len(score) >= k and upper[left[at]] < score[k - 1]:
                    break  # no candidate left can reach the k-th score
                some = others[left[at:at + EVALUATED_AT_ONCE]]
                at += len(some)
                score, found = np.r_[score, x[some] @ q[n]], np.r_[found, some]
                top = np.lexsort((ids[found], -score))[:k]
                score, found = score[top], found[top]
            out.append((np.full(len(found), own), ids[found], score, np.full(len(found), at)))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2].astype(np.int64)),
                         "evaluated": pa.array(cols[3], pa.int64())})
    return run


def top_k(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each row for which the
    column expression ``is_query`` over ``id`` holds; ties go to the smaller id."""
    table = written(pivot_table(integer_vectors(df, id_col, vec_col))
                    .withColumn("n", F.monotonically_increasing_id()), "pivots")
    asked = table.filter(is_query & F.col("id").isNotNull()).dropDuplicates(["id", "v"])
    query_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    row_blocks = max(1, -(-table.count() // BLOCK_ROWS))
    part = lambda blocks: F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int")
    columns = ["id", "v", "dim", "pivot_distances"]
    left = asked.select(*columns, part(query_blocks).alias("qb"),
                        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    right = table.select(*[F.col(c).alias(c) for c in columns],
                         F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
                         part(row_blocks).alias("rb"))
    right = right.toDF(*columns, "qb2", "rb2").withColumnRenamed("dim", "dim2").select(
        "id", "v", F.col("dim2"), "pivot_distances", "qb2", "rb2")
    some = (left.groupBy("dim", "qb", "rb").cogroup(right.groupBy("dim2", "qb2", "rb2"))
            .applyInArrow(_best(k), "query_id long, vec_id long, score long, evaluated long"))
    best = some.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("least"), F.col("vec_id").alias("vec_id")))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.when(F.col("b.vec_id") != int(NO_ID), F.col("b.vec_id")).alias("vec_id"),
        (-F.col("b.least")).alias("score"))
