"""Spark session settings the rollups depend on.

Every time bucket (day, minute, hour, quarter, date, year) is defined in UTC, so the
session zone is pinned to UTC. Joins and aggregations are left to Catalyst + AQE:
adaptive execution re-plans on measured shuffle sizes, splits skewed join partitions
and coalesces small ones.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings applied to every session the library builds. Static broadcast by estimate is
# switched off: the planner's estimate for a compressed Parquet scan is not a bound on
# its in-memory size. Dimension sides are broadcast only through
# ``operators.joins.bounded_broadcast`` (a counted bound); everything else may still be
# turned into a broadcast by AQE from *measured* shuffle output.
SESSION_CONF = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition keys of the stored tables are text (yyyyMM, YYYYQn, yyyy)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (bucket semantics need it); return the session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, slots: int) -> int:
    """Shuffle partitions so one partition carries about 256 MB of the largest input (it
    fits executor memory and sort buffers without heavy spill); AQE coalesces small ones
    and splits skewed ones at run time. Never fewer than two per task slot."""
    return int(max(2 * slots, 1, -(-input_bytes // TARGET_SHUFFLE_PARTITION_BYTES)))


def get_session(
    master: str | None = None,
    app_name: str = "bankroll",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    slots: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library settings.

    Shuffle partitions: ``shuffle_partitions`` if given; else sized from ``input_bytes``
    (the largest table a job reads) and ``slots`` (total task slots of the cluster) by
    ``shuffle_partitions_for``; else Spark's own setting stays as it is.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes, slots or 0)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    use_utc(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and landed tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared file system there).
    Only when it is unset and the master is local (one machine) a fresh scratch folder is
    created and registered, so later lookups return the same place; on a cluster an unset
    folder is an error, as each machine would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        registered = spark.sparkContext.getCheckpointDir()
        if registered:
            # the context appends a random child folder; the shared root is its parent
            return registered.rstrip("/").rsplit("/", 1)[0]
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="bankroll-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        return path
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder below the shared checkpoint folder."""
    import uuid

    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/bankroll/{name}-{uuid.uuid4().hex[:12]}"
