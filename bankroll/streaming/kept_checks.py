"""QC3 and QC4 kept fresh by what each batch changes: a late parent clears its orphans, a
second row of a key is a violation until one of them is taken back.

A batch adds rows to some tables and takes others back. Its rows are counted per key and
column first (a key on a third of them is one row per task), the counts are stored under the
batch's number, and the earlier counts of just these keys tell what the checks gave for them
before and give now. Only that difference is stored; the checks are its sums. Keys meet only those of columns
that foreign keys link to theirs (a domain), so a batch of accounts reads no transaction's id, and the first
keys of a column that none refers to are not shuffled a second time.

A batch reads the counts of earlier batches, never the tables. They grow with the distinct
keys of the history. A replayed batch replaces its folders and reads nothing from its own
number on. Null foreign keys are no violation; several null primary keys count as one value
that repeats, as in ``operators.quality``. Empty batches change nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import FOREIGN_KEYS, PRIMARY_KEYS
from ..operators.joins import bounded_broadcast

_PRIMARY = {table: keys[0] for table, keys in PRIMARY_KEYS.items()}
COLUMNS = sorted({(t, c) for child, ccol, parent, pcol in FOREIGN_KEYS for t, c in ((child, ccol), (parent, pcol))}
                 | set(_PRIMARY.items()))


def _domains() -> list[int]:
    """Of each column the first of those that foreign keys link it to, itself included."""
    first = {c: at for at, c in enumerate(COLUMNS)}
    for _ in COLUMNS:
        for child, ccol, parent, pcol in FOREIGN_KEYS:
            first[child, ccol] = first[parent, pcol] = min(first[child, ccol], first[parent, pcol])
    return [first[c] for c in COLUMNS]


DOMAIN = _domains()
_NULL = ""  # keys are stored with a sign before them, so this is none of them


def _occurrences(tables: Mapping[str, DataFrame], sign: int) -> list[DataFrame]:
    out = []
    for at, (table, column) in enumerate(COLUMNS):
        if table in tables:
            key = F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(_NULL))
            out.append(tables[table].select(F.lit(at).alias("item"), key.alias("key"), F.lit(sign).alias("n")))
    return out


def _violations(count) -> list[tuple[str, str, str, Column]]:
    """(rule, table, item, violations of one key), given the count of a column's key."""
    found = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        lone = (F.col("key") != _NULL) & (count(parent, pcol) <= 0)
        found.append(("QC3", child, f"{ccol}->{parent}.{pcol}",
                      F.when(lone, count(child, ccol)).otherwise(F.lit(0).cast("bigint"))))
    for table, column in _PRIMARY.items():
        found.append(("QC4", table, column, (count(table, column) > 1).cast("bigint")))
    return found


def apply(spark: SparkSession, out: str, batch_id: int, added: Mapping[str, DataFrame],
          removed: Mapping[str, DataFrame] | None = None) -> None:
    """Take in one batch: rows ``added`` to and ``removed`` from the tables named (a changed row
    is removed as it was and added as it is)."""
    out = out.rstrip("/")
    parts = _occurrences(added, 1) + _occurrences(removed or {}, -1)
    path = f"{out}/counts/batch_id={batch_id}"
    schema = "item int, key string, n bigint"
    changed = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    (changed.groupBy("item", "key").agg(F.sum("n").alias("n")).filter(F.col("n") != 0)
     .write.mode("overwrite").option("compression", "zstd").parquet(path))
    domain = F.element_at(F.array(*[F.lit(d) for d in DOMAIN]), F.col("item") + 1).alias("domain")
    new = spark.read.schema(schema).parquet(path).select("*", domain, F.lit(True).alias("new"))
    tables = {*added, *(removed or {})}
    touched = {DOMAIN[at] for at, (table, _) in enumerate(COLUMNS) if table in tables}
    items = [at for at in range(len(COLUMNS)) if DOMAIN[at] in touched]
    old = (spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{out}/counts")
           .filter((F.col("batch_id") < batch_id) & F.col("item").isin(items))
           .select("item", "key", "n", domain, F.lit(False).alias("new")))
    parts = []
    for at in range(len(COLUMNS)):
        of = F.col("item") == at
        parts += [(f"before_{at}", F.when(of & ~F.col("new"), F.col("n"))), (f"after_{at}", F.when(of, F.col("n")))]
    lone = F.lit(False)
    if old.isEmpty():  # a key of a column without others in its domain is one row
        lone = F.col("domain").isin([d for d in touched if DOMAIN.count(d) == 1])
        rows = new.filter(~lone)
    else:
        keys, few = bounded_broadcast(new.select("domain", "key"))
        rows = new.unionByName(old.join(keys, ["domain", "key"], "left_semi").select(*new.columns) if few else old)
    # a key has a row per column and batch, so rows are dealt as they are and made wide where they met
    per_key = (rows.repartition("domain", "key").groupBy("domain", "key")
               .agg(F.max("new").alias("new"), *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in parts])
               .filter("new").drop("domain", "new"))
    per_key = per_key.unionByName(new.filter(lone).select(
        "key", *[F.coalesce(c, F.lit(0)).alias(name) for name, c in parts]))
    before, after = [_violations(lambda t, c, w=when: F.col(f"{w}_{COLUMNS.index((t, c))}"))
                     for when in ("before", "after")]
    totals = per_key.agg(*[F.coalesce(F.sum(a[3] - b[3]), F.lit(0)).alias(f"d{i}")
                           for i, (a, b) in enumerate(zip(after, before))])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(t).alias("tbl"), F.lit(i).alias("item"),
                              F.col(f"d{k}").alias("change")) for k, (r, t, i, _) in enumerate(after)])
    totals.select(F.inline(rows)).write.mode("overwrite").parquet(f"{out}/changes/batch_id={batch_id}")


def read_view(spark: SparkSession, out: str) -> DataFrame:
    """``(rule, tbl, item, violations)`` of QC3 and QC4 after the batches so far."""
    return (spark.read.schema("rule string, tbl string, item string, change bigint")
            .parquet(f"{out.rstrip('/')}/changes").groupBy("rule", "tbl", "item")
            .agg(F.sum("change").alias("violations")))
