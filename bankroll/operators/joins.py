"""Join helpers: size-checked broadcast, lookup joins with a skew path.

Policy
------
* A side is broadcast only after it was *measured* to be within the bounds on rows and on
  bytes (``measure``): one pass over the narrow columns of the table the side comes from,
  whose tasks report their counts to the driver; no exchange, and nothing of a derived
  side's plan runs. The measure is kept with the DataFrame it was taken from and goes with it.
* Beyond the bounds the join is a shuffle join. Spark's adaptive execution splits a skewed
  join partition; ``lookup_join`` also salts hot keys, as many salts as their row count
  asks for, so one key holding a third of all rows never lands in one task.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

CONF_MAX_BROADCAST_ROWS = "bankroll.broadcast.maxRows"
CONF_MAX_BROADCAST_BYTES = "bankroll.broadcast.maxBytes"
CONF_HOT_KEY_ROWS = "bankroll.skew.hotKeyRows"
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_HOT_KEY_ROWS = 5_000_000
STREAM_SALTS = 8

_MEASURED: WeakKeyDictionary[DataFrame, dict[tuple[str, ...], tuple[int, int]]] = WeakKeyDictionary()


def _conf(df: DataFrame, name: str, default: int) -> int:
    value = df.sparkSession.conf.get(name, None)
    return int(value) if value else default


def max_broadcast_rows(df: DataFrame) -> int:
    return _conf(df, CONF_MAX_BROADCAST_ROWS, DEFAULT_MAX_BROADCAST_ROWS)


def max_broadcast_bytes(df: DataFrame) -> int:
    return _conf(df, CONF_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_BYTES)


def measure(df: DataFrame, columns: list[str]) -> tuple[int, int]:
    """(rows, bytes of the values) of ``columns`` of ``df``."""
    kept = _MEASURED.setdefault(df, {})
    key = tuple(columns)
    if key not in kept:
        size = F.lit(0).cast("long")
        for c in columns:
            text = isinstance(df.schema[c].dataType, T.StringType)
            size = size + (F.coalesce(F.octet_length(c), F.lit(0)).cast("long") if text else F.lit(8).cast("long"))
        seen = Observation()
        (df.select(*columns, size.alias("__size")).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.sum("__size").alias("bytes"))
         .write.format("noop").mode("overwrite").save())
        kept[key] = (seen.get["rows"], seen.get["bytes"] or 0)
    return kept[key]


def bounded_broadcast(df: DataFrame, max_rows: int | None = None,
                      rows_of: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Return ``(df with a broadcast hint, True)`` if it was measured to be within the bounds,
    else ``(df, False)`` -- the caller's join then shuffles. ``rows_of``: the table that
    ``df`` is derived from, with at least as many rows; it is measured in place of it."""
    source = rows_of if rows_of is not None else df
    rows, size = measure(source, [c for c in df.columns if c in source.columns])
    bound = max_rows if max_rows is not None else max_broadcast_rows(df)
    if rows <= bound and size <= max_broadcast_bytes(df):
        return F.broadcast(df), True
    return df, False


def _salted(fact: DataFrame, dim: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join of a fact and a dimension that both carry ``__salts``, the salts of their key."""
    row = F.xxhash64(*[F.col(c) for c in fact.columns if c != "__salts"])
    fact = fact.withColumn("__salt", F.pmod(row, F.col("__salts")).cast("int")).drop("__salts")
    dim = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts").cast("int") - 1))).drop("__salts")
    return fact.join(dim, keys + ["__salt"], how).drop("__salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_rows: int | None = None,
    split_hot: bool = True,
    hot_key_rows: int | None = None,
    rows_of: DataFrame | None = None,
) -> DataFrame:
    """N:1 equi-join of a fact table to a dimension keyed by ``on`` (inner or left).

    Broadcast when the dimension (or ``rows_of``, the table it comes from) is measured
    small; otherwise a shuffle join in which hot keys are split: the facts are counted per
    key once (a partially aggregated count) and the keys above ``hot_key_rows`` kept in the
    shared folder; a key gets one salt per ``hot_key_rows`` rows, its dimension row is
    repeated per salt. So the facts are read twice. Should more keys be hot than may be
    broadcast, the row count that makes a key hot is doubled until they fit. The keys of a
    stream cannot be counted beforehand: there every key gets ``STREAM_SALTS`` salts (a
    micro-batch bounds the rows of each). The result is the same multiset of rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small, is_small = bounded_broadcast(dim, max_rows, rows_of)
    if is_small:
        return fact.join(small, keys, how)
    if not split_hot:
        return fact.join(dim, keys, how)
    if fact.isStreaming:
        salts = F.lit(STREAM_SALTS)
        return _salted(fact.withColumn("__salts", salts), dim.withColumn("__salts", salts), keys, how)

    spark = fact.sparkSession
    target = hot_key_rows or _conf(fact, CONF_HOT_KEY_ROWS, DEFAULT_HOT_KEY_ROWS)
    path = scratch_dir(spark, "hot-keys")
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > target)
    counts.write.parquet(path)
    hot = spark.read.schema(counts.schema).parquet(path)
    bound = max_rows if max_rows is not None else max_broadcast_rows(fact)
    while hot.filter(F.col("__n") > target).count() > max(bound, 1):
        target *= 2
    salts = F.ceil(F.col("__n") / target).cast("int")
    side = F.broadcast(hot.filter(F.col("__n") > target).select(*keys, salts.alias("__salts")))
    one = F.coalesce("__salts", F.lit(1)).alias("__salts")
    return _salted(fact.join(side, keys, "left").select(*fact.columns, one),
                   dim.join(side, keys, "left").select(*dim.columns, one), keys, how)


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row."""
    parents = parent.select(F.col(parent_col).alias("__pk"))
    return (child.filter(F.col(child_col).isNotNull())
            .join(parents, F.col(child_col) == F.col("__pk"), "left_anti"))


def orphan_count(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Number of child rows without parent, as one row ``violations``.

    Child rows are first counted per key (partial aggregation: a key holding a third of
    all rows is one row per map task), so the anti join shuffles distinct keys only.
    """
    per_key = (child.filter(F.col(child_col).isNotNull())
               .groupBy(F.col(child_col).alias("__fk")).agg(F.count(F.lit(1)).alias("__n")))
    parents = parent.select(F.col(parent_col).alias("__pk"))
    missing = per_key.join(parents, F.col("__fk") == F.col("__pk"), "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("violations"))
