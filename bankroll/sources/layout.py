"""Storage of the result tables and the file sinks.

Serving layout (S11): each result table is written as Parquet, partitioned by a coarse
derived text column (month, quarter or year -- never minute, day or account, which would
make one directory per key) and sorted inside every file, so the reads prune whole directories by
the partition filter and row groups by min/max statistics on the sort keys (the role of
the reference's partition keys, clustering order and secondary index).

Rows are range-partitioned on ``(partition column, sort keys)`` before the write: a
task receives a contiguous key range, so one hot partition value (a month holding a
third of all rows) is spread over many tasks and files rather than one, and each file
covers a narrow, sorted slice of the keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions_for
from .records import encode


@dataclass(frozen=True)
class Layout:
    partition_col: str | None
    derive: Callable[[], Column] | None   # computes the partition column (None: already there)
    sort: tuple[tuple[str, bool], ...]    # (column, descending) keys inside files

    def sort_cols(self) -> list[Column]:
        return [F.col(c).desc() if desc else F.col(c) for c, desc in self.sort]


def _month_of(c: str) -> Callable[[], Column]:
    """``yyyyMM`` from a ``yyyyMMdd...`` key."""
    return lambda: F.substring(c, 1, 6)


# Partition column and clustering order per result table.
LAYOUTS: dict[str, Layout] = {
    "q1": Layout("txn_month", _month_of("txn_day"),
                 (("account_id", False), ("txn_timestamp", True), ("txn_id", False))),
    "q2": Layout("txn_month", _month_of("txn_minute"),
                 (("txn_minute", False), ("txn_time", True), ("txn_id", False))),
    "q3": Layout("txn_month", lambda: F.date_format("window_start", "yyyyMM"),
                 (("window_start", False), ("city", False))),
    "q3r": Layout("txn_month", _month_of("bucket_hour"),
                  (("bucket_hour", False), ("city", False), ("txn_id", False))),
    "q4": Layout("quarter", None, (("employee_id", False), ("txn_time", True), ("txn_id", False))),
    "q5a": Layout(None, None, (("customer_id", False),)),
    "q5b": Layout("quarter", None, (("customer_id", False),)),
    "q5": Layout("quarter", None, (("customer_id", False),)),
    "q6": Layout("txn_year", None, (("branch_id", False), ("txn_date", False))),
}

# Ids that rows are found by beside the keys above, with the distinct values expected in a row
# group. A filter takes about 10 bits a value, so 125 KB for 100,000.
LOOKUPS: dict[str, dict[str, int]] = {
    "q1": {"txn_id": 1_000_000},
    "q2": {"txn_id": 1_000_000, "account_id": 100_000},
    "q3r": {"txn_id": 1_000_000},
    "q4": {"txn_id": 1_000_000},
}

# A byte of a packed Parquet file becomes about so many bytes of shuffled rows (nine for Q1, reckoned from F21).
UNPACKED = 8
# Text sinks are packed; as one task reads a packed file whole, a file has at most so many rows.
PACKED = {"compression": "gzip", "maxRecordsPerFile": "1000000"}


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Partitions of a range write: as asked, else one per ``TARGET_SHUFFLE_PARTITION_BYTES``
    of the files that ``df`` reads, unpacked."""
    if partitions:
        return partitions
    size = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total, at = 0, size.iterator()
    while at.hasNext():
        total += min(int(str(at.next().stats().sizeInBytes())), 1 << 60)
    return shuffle_partitions_for(total * UNPACKED, 0)


def clustered(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Add the partition column and order rows for the serving layout of ``name``."""
    lay, keys = LAYOUTS[name], LAYOUTS[name].sort_cols()
    if not lay.partition_col:
        return df.repartitionByRange(_partitions(df, partitions), *keys).sortWithinPartitions(*keys)
    part = F.col(lay.partition_col) if lay.derive is None else lay.derive()
    dealt = df.repartitionByRange(_partitions(df, partitions), part, *keys)
    return dealt.withColumn(lay.partition_col, part).sortWithinPartitions(lay.partition_col, *keys)


def write_result(df: DataFrame, name: str, path: str, mode: str = "overwrite",
                 partitions: int | None = None, max_records_per_file: int = 5_000_000,
                 partition_overwrite: str = "dynamic", lookups: dict[str, int] | None = None) -> None:
    """Write result table ``name`` in its serving layout (Parquet).

    ``lookups`` are id columns looked up without the layout's own keys (the role of a secondary
    index), each with the distinct values expected in a row group; default ``LOOKUPS``. Parquet
    keeps a Bloom filter of theirs in every row group that has no complete dictionary, so an
    equality on such a column skips row groups whose ids merely surround it.

    ``partition_overwrite``: ``dynamic`` replaces only the partitions present in ``df``
    (incremental refresh of some months), ``static`` replaces the whole table.
    """
    lay = LAYOUTS[name]
    w = (clustered(df, name, partitions).write.mode(mode)
         .option("maxRecordsPerFile", max_records_per_file)
         .option("partitionOverwriteMode", partition_overwrite).option("compression", "zstd")
         .options(**bloom_options(LOOKUPS.get(name, {}) if lookups is None else lookups)))
    if lay.partition_col:
        w = w.partitionBy(lay.partition_col)
    w.parquet(path)


def bloom_options(lookups: dict[str, int]) -> dict[str, str]:
    """Parquet writer options: a Bloom filter of each column, sized for its distinct values."""
    options = {}
    for column, distinct in lookups.items():
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(distinct)
    return options


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored result table; the partition column comes back as a (text) column, so
    the reads in ``plans.reads`` prune on it."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark.read.parquet(path)


def save_table(df: DataFrame, table: str, path: str, name: str | None = None,
               mode: str = "overwrite") -> None:
    """Register a result as a named Parquet table at ``path`` (readable by any engine
    that reads Parquet; by name from this session's catalog)."""
    w = clustered(df, name, None).write if name in LAYOUTS else df.write
    if name in LAYOUTS and LAYOUTS[name].partition_col:
        w = w.partitionBy(LAYOUTS[name].partition_col)
    w.mode(mode).format("parquet").option("path", path).saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Store ``df`` as table ``table`` in ``buckets`` buckets of ``key`` (J1, S11). Tables stored with one key and
    number of buckets are joined and grouped on that key without an exchange of either (read them by name:
    ``spark.table``). Rows are dealt by key before the write, so a bucket is one file of one task.

    Take ``buckets`` so that a bucket suits a task (``session.shuffle_partitions_for`` of the bytes). All rows of a
    key share a bucket, which one task reads, so this is for tables whose largest key suits a task too; with a
    larger one keep the plain tables, whose rollups reduce per key in every task before they shuffle."""
    (df.repartition(buckets, F.col(key)).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .format("parquet").option("path", path).saveAsTable(table))


def write_json(tables: dict[str, DataFrame], out_dir: str, mode: str = "overwrite") -> None:
    """One line-delimited JSON file set per table (distributed write, one folder each, packed), in
    the wire form of the contract; a null field is written as null."""
    for name, df in tables.items():
        (encode(df, name).write.mode(mode).option("ignoreNullFields", False).options(**PACKED)
         .json(f"{out_dir.rstrip('/')}/{name}"))


def write_csv(tables: dict[str, DataFrame], out_dir: str, mode: str = "overwrite") -> None:
    """One packed CSV file set with header per table, in the wire form of the contract."""
    for name, df in tables.items():
        (encode(df, name).write.mode(mode).option("header", True).options(**PACKED)
         .csv(f"{out_dir.rstrip('/')}/{name}"))
