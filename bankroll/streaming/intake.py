"""Intake of the transaction stream: every line ends in one of three tables.

* ``kept``: rows at or after the watermark of their micro-batch;
* ``late``: rows behind it, with that watermark, instead of vanishing;
* ``quarantine``: lines that are no transaction, with the reason (``sources.records.decode``).

The watermark of a micro-batch is the greatest event time of all batches before it less the
delay, as Spark has it for its own stateful operators. Each batch observes its greatest time
while it is written and stores the running maximum under its number, so a batch reads one
row of its predecessor and a replayed batch decides as it did at first: it replaces its own
folders and reads nothing later than itself.

Null times go to the quarantine and move no watermark; repeated rows are kept each; an empty
batch passes the maximum on; an empty stream gives empty views.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import buckets as B
from ..model import CORRUPT, SCHEMAS, WATERMARK_DELAY
from ..sources.records import decode
from .sources import changelog_schema

FATES = ("kept", "late")
_MAXIMUM = T.StructType([T.StructField("latest", T.TimestampType())])
_ROWS = T.StructType([*SCHEMAS["transaction"].fields, T.StructField("seq", T.LongType()),
                      T.StructField("watermark", T.TimestampType()), T.StructField("fate", T.StringType()),
                      T.StructField("batch_id", T.LongType())])
_BAD = T.StructType([*changelog_schema("transaction").fields, T.StructField(CORRUPT, T.StringType()),
                     T.StructField("reason", T.StringType()), T.StructField("batch_id", T.LongType())])


def land(batch: DataFrame, batch_id: int, out: str, delay: str = WATERMARK_DELAY, check_ids: bool = True) -> None:
    """Write one micro-batch of wire transactions (``foreachBatch``)."""
    spark, out = batch.sparkSession, out.rstrip("/")
    before = (spark.read.schema(_MAXIMUM).parquet(f"{out}/maxima/batch_id={batch_id - 1}").first().latest
              if batch_id else None)
    good, bad = decode(batch, "transaction", check_ids)
    watermark = B.minus_interval(F.lit(before).cast("timestamp"), delay)
    late = F.coalesce(F.col("txn_time") < watermark, F.lit(False))
    seen = Observation()
    (good.observe(seen, F.max("txn_time").alias("latest"))
     .withColumn("watermark", watermark).withColumn("fate", F.when(late, F.lit("late")).otherwise(F.lit("kept")))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("fate")
     .parquet(f"{out}/rows/batch_id={batch_id}"))
    bad.write.mode("overwrite").parquet(f"{out}/quarantine/batch_id={batch_id}")
    times = [t for t in (before, seen.get["latest"]) if t is not None]
    (spark.createDataFrame([(max(times) if times else None,)], _MAXIMUM).coalesce(1)
     .write.mode("overwrite").parquet(f"{out}/maxima/batch_id={batch_id}"))


def start(wire: DataFrame, out: str, *, checkpoint: str | None = None, delay: str = WATERMARK_DELAY,
          check_ids: bool = True, available_now: bool = False):
    """Run the intake of a stream of wire transactions (``sources.read_stream``)."""
    w = wire.writeStream.foreachBatch(lambda batch, n: land(batch, n, out, delay, check_ids)).option(
        "checkpointLocation", checkpoint or f"{out.rstrip('/')}_checkpoint")
    return (w.trigger(availableNow=True) if available_now else w).start()


def _view(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no batch yet


def rows(spark: SparkSession, out: str, fate: str) -> DataFrame:
    """The transactions ``kept`` or ``late``, with the watermark they were held against and
    the batch they came in; one fate prunes the folders of the other."""
    if fate not in FATES:
        raise ValueError(f"a fate is one of {FATES}")
    return _view(spark, f"{out.rstrip('/')}/rows", _ROWS).filter(F.col("fate") == fate).drop("fate")


def quarantined(spark: SparkSession, out: str) -> DataFrame:
    return _view(spark, f"{out.rstrip('/')}/quarantine", _BAD)
