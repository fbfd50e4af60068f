"""Places and running sums within keys, without one task per key.

A window over a key runs in one task, however many rows the key has. Here the rows are dealt
to ranges of (key, order) instead, so a key with very many rows spans many ranges. Each range
is summed for itself, and what a key has in earlier ranges is added: only a range's first key
has any, so that is at most one row a range, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

_RANGE_BITS = 33  # Spark's increasing ids hold the partition above these bits


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` in ranges of (keys, order), kept in the shared folder, with ``__at``: a number that
    ascends in that order."""
    spark = df.sparkSession
    path = scratch_dir(spark, "ranges")
    cols = [F.col(k).asc_nulls_first() for k in keys] + [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running(laid: DataFrame, keys: Sequence[str], sums: dict[str, Column] | None = None,
            xors: dict[str, Column] | None = None) -> DataFrame:
    """The rows of ``lay_out`` with, for each name, the sum (or the exclusive or) of a column over
    the rows of its key up to its own."""
    sums, xors = sums or {}, xors or {}
    names = [*sums, *xors]
    fold = {**{n: F.sum for n in sums}, **{n: F.bit_xor for n in xors}}
    add = {**{n: lambda a, b: a + b for n in sums}, **{n: lambda a, b: a.bitwiseXOR(b) for n in xors}}
    rows = laid.withColumns({f"__v_{n}": c.cast("long") for n, c in {**sums, **xors}.items()})
    rows = rows.withColumn("__range", F.shiftright("__at", _RANGE_BITS))
    inside = Window.partitionBy(*keys, "__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumns({f"__h_{n}": fold[n](f"__v_{n}").over(inside) for n in names})
    ranges = rows.groupBy(*keys, "__range").agg(*[fold[n](f"__v_{n}").alias(f"__b_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__range").alias("__k_range"),
                            F.row_number().over(Window.partitionBy(*keys).orderBy("__range")).alias("__k_nth"),
                            *[fold[n](f"__b_{n}").over(before).alias(f"__c_{n}") for n in names])
    carried = F.broadcast(carried.filter("__k_nth > 1"))  # at most one row a range
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [
        F.col("__range") == F.col("__k_range")])
    zero = F.lit(0).cast("long")
    return here.join(carried, same, "left").select(
        *[c for c in laid.columns if c != "__at"],
        *[add[n](F.col(f"__h_{n}"), F.coalesce(f"__c_{n}", zero)).alias(n) for n in names])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "place") -> DataFrame:
    """``df`` with the place, from 1, of each row among the rows of its key. Rows that are equal
    in ``order`` get their places in any order."""
    return running(lay_out(df, keys, order), keys, {name: F.lit(1)})
