"""Streaming sources: the transaction stream and the dimension changelogs.

Each source is a folder of JSON-lines (or Parquet) files in the wire form of its
contract (``sources.records``): transactions carry ``txn_time`` as epoch milliseconds,
dimension records carry ISO text times plus a ``seq`` version (update time or source
offset) so two versions of one key inside one micro-batch are ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CORRUPT, FIELD_ORDER, WATERMARK_DELAY
from ..sources.records import wire_schema

DIMENSIONS = ("account", "branch", "employee", "customer", "product")
KINDS = ("transaction",) + DIMENSIONS


def changelog_schema(table: str) -> T.StructType:
    """Wire schema of ``table`` plus the ``seq`` version column."""
    return T.StructType(wire_schema(table).fields + [T.StructField("seq", T.LongType(), True)])


def read_stream(spark: SparkSession, path: str, table: str, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Schema-first stream of wire records of ``table`` (never inferred). A JSON line that is
    no record of the schema keeps its text in ``_corrupt_record``."""
    schema = changelog_schema(table)
    r = spark.readStream.format(fmt)
    if fmt == "json":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def typed_transactions(wire: DataFrame) -> DataFrame:
    """Wire transactions (epoch-millis time) to typed rows (F8) in contract order; lines that
    did not parse are left out."""
    if CORRUPT in wire.columns:
        wire = wire.filter(F.col(CORRUPT).isNull())
    return wire.withColumn("txn_time", F.timestamp_millis("txn_time")).select(*FIELD_ORDER["transaction"])


def with_watermark(txn: DataFrame, delay: str | None = WATERMARK_DELAY) -> DataFrame:
    """Event-time watermark ``txn_time - delay`` (``None``: no watermark)."""
    return txn.withWatermark("txn_time", delay) if delay else txn


def tagged_union(streams: dict[str, DataFrame]) -> DataFrame:
    """One stream of all kinds: ``kind``, ``seq`` and one nullable struct per kind, so a
    single query (one checkpoint, one ``batch_id``) sees every change."""
    parts = []
    for kind, df in streams.items():
        cols = [c for c in df.columns if c != "seq"]
        seq = F.col("seq") if "seq" in df.columns else F.lit(None).cast("long")
        parts.append(df.select(F.lit(kind).alias("kind"), F.coalesce(seq, F.lit(0)).alias("seq"),
                               F.struct(*cols).alias(kind)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
