"""Stream-static refresh: the cheaper mode for dimensions that do not change.

The transaction stream is joined to static dimension tables and aggregated with Spark's
stateful streaming aggregation (``update`` output mode, RocksDB state store); every
micro-batch emits the groups it changed with their full current values, and
``foreachBatch`` writes them as ``results/<name>/batch_id=N`` -- the same keyed layout
and read view as the landed mode. Row results (Q1, Q2, Q3R, Q4) are appended.

What this mode does not do, by construction: it never revises results when a dimension
row changes, and a transaction whose account is not yet known is dropped by the inner
join instead of waiting (use ``landed.LandedRefresh`` for both).

Options: with ``drop_late`` the event-time watermark (T1, ``txn_time - watermark``) is
applied, so rows older than it are dropped and the state of the windowed aggregation (Q3)
is evicted (T4); ``dedupe`` drops re-delivered transactions inside the watermark (T9).
Both are off by default, a choice: Spark drops rows behind a watermark, whereas the
maintained tables are updating aggregations in which every late row counts, so the state
of every group is kept (T3) unless dropping is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import RESULT_KEYS, WATERMARK_DELAY
from ..operators.compaction import latest_by_key
from ..plans import rollups as R
from ..session import checkpoint_dir
from .sources import typed_transactions, with_watermark

APPEND_ONLY = ("q1", "q2", "q3r", "q4")
AGGREGATES = ("q3", "q5b", "q6")


def rollup_stream(name: str, wire_txns: DataFrame, dims: dict[str, DataFrame],
                  watermark: str | None = WATERMARK_DELAY, drop_late: bool = False,
                  dedupe: bool = False) -> DataFrame:
    """Streaming DataFrame of result ``name`` over a wire transaction stream."""
    x = typed_transactions(wire_txns)
    if watermark and (drop_late or dedupe):
        x = with_watermark(x, watermark)
    if dedupe:
        x = x.dropDuplicatesWithinWatermark(["txn_id"])
    return R.ROLLUPS[name]({"transaction": x, **dims})


def start(name: str, wire_txns: DataFrame, dims: dict[str, DataFrame], out_path: str | None = None,
          checkpoint: str | None = None, available_now: bool = False,
          processing_time: str | None = None, **opts):
    """Run result ``name`` as a streaming query writing keyed micro-batches to ``out_path``
    (default ``<spark.checkpoint.dir>/bankroll/stream/<name>``; checkpoint beside it)."""
    if out_path is None:
        out_path = f"{checkpoint_dir(wire_txns.sparkSession).rstrip('/')}/bankroll/stream/{name}"
    checkpoint = checkpoint or f"{out_path.rstrip('/')}_checkpoint"
    stream = rollup_stream(name, wire_txns, dims, **opts)
    mode = "append" if name in APPEND_ONLY else "update"

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("deleted", F.lit(False))
         .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    w = (stream.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_view(spark, name: str, out_path: str) -> DataFrame:
    """Newest row per result key over the written micro-batches."""
    df = spark.read.parquet(out_path).withColumn("batch_id", F.col("batch_id").cast("long"))
    return latest_by_key(df, RESULT_KEYS[name], "batch_id", drop_deleted="deleted").drop("batch_id")
