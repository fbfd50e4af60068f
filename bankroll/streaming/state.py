"""Starting queries that keep state of their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"


def started(spark: SparkSession, writer, available_now: bool, processing_time: str | None, partitions: int | None):
    """Start ``writer`` with its state in RocksDB. The number of state partitions is fixed by a
    query's first start, so it may be given apart from the session's. A query takes its settings when
    it starts; the session has its own back afterwards."""
    wanted = {STORE: ROCKS, **({PARTITIONS: str(partitions)} if partitions else {})}
    before = {k: spark.conf.get(k, None) for k in wanted}
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
