"""Row results as joins of streams (T6): a transaction waits in state for its dimension rows.

Q3R and Q4 join the transaction stream to the changelogs of account and branch, or employee and
branch, all of them streams. Both sides of each join are kept in state, so it does not matter which
comes first, and every pair is given out once (append mode). A dimension row that comes in a newer version
gives its transactions again; the read view keeps the newest version of each.

``wait`` bounds the state: a transaction meets versions up to ``wait`` later than itself (their
``seq`` is then the update time in epoch milliseconds) and leaves the state once the watermark of the
changelogs is past that. Without it no pair is ever missed and the state grows with the stream, as it
must for a join without a time bound. Dimension rows stay in state either way.

A busy account or branch is dealt to ``salts`` state partitions: each of its transactions goes to one,
the dimension row to all. That is every key, so an account is kept ``salts`` times, unless the caller names the
``busy`` ones (``busy_keys`` of what is known of the stream), as it should where accounts are many. Without
``wait`` a transaction meets its account first and the branch then: so a branch's version meets rows that are
kept once, where the other order would keep each account once more per salt and version of its branch.

Cases: records that do not decode go to ``rejected``; nulls in a join key meet nothing; a transaction
delivered again gives its row again and counts once in the read view, its newest ``seq`` winning (one that
no longer passes the result's filter is not taken back: ``landed`` does that); an empty stream gives an
empty table. A version whose new branch is not known yet leaves the former version in the read view.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..model import CITY_HIGH_VALUE, RESULT_KEYS, SCHEMAS, WATERMARK_DELAY
from ..operators.compaction import latest_by_key
from ..operators.joins import DEFAULT_HOT_KEY_ROWS, STREAM_SALTS
from ..plans import rollups as R
from ..session import checkpoint_dir, scratch_dir
from ..sources.records import decode
from .sources import read_stream
from .state import started

# result -> (dimension between transaction and branch, its key, the transaction's key)
PATHS = {"q3r": ("account", "account_id", "account_id"), "q4": ("employee", "emp_id", "approved_by_emp_id")}
BRANCH_SALTS = 64  # branches are few and each has many rows
VERSIONS = ("txn_seq", "dim_seq", "branch_seq")


def busy_keys(name: str, txns: DataFrame, rows: int = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``rows`` transactions of result ``name``, as wire text, kept in the shared folder."""
    spark, (_, key, own) = txns.sparkSession, PATHS[name]
    path = scratch_dir(spark, "busy-keys")
    many = _passing(name, txns).groupBy(F.col(own).cast("string").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    many.filter(F.col("n") > rows).select(key).write.parquet(path)
    return spark.read.schema(f"{key} string").parquet(path)


def _met(rows: DataFrame, row_id: str, dim: DataFrame, key: str, salts: int, bound: F.Column | None = None,
         busy: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key``, the rows of one key dealt to ``salts`` parts by ``row_id``; of the keys in ``busy``
    alone, if that is given."""
    columns, parts = (rows.columns, dim.columns), F.lit(salts)
    if busy is not None:
        some = F.broadcast(busy.select(key, F.lit(salts).alias("parts")))
        rows, dim, parts = rows.join(some, key, "left"), dim.join(some, key, "left"), F.coalesce("parts", F.lit(1))
    left = rows.select(*columns[0], F.pmod(F.xxhash64(row_id), parts).cast("int").alias("salt"))
    right = dim.select(*[F.col(c).alias(f"d_{c}") for c in columns[1]],
                       F.explode(F.sequence(F.lit(0), parts - 1)).alias("d_salt"))
    on = (F.col(key) == F.col(f"d_{key}")) & (F.col("salt") == F.col("d_salt"))
    joined = left.join(right, on if bound is None else on & bound)
    kept = [*columns[0], *[F.col(f"d_{c}").alias(c) for c in columns[1] if c not in columns[0]]]
    return joined.select(*kept)


def _passing(name: str, x: DataFrame) -> DataFrame:
    if name == "q3r":
        return x.filter(B.above("amount", CITY_HIGH_VALUE))
    return x.filter((F.col("txn_type") == "Withdrawal") & F.col("approved_by_emp_id").isNotNull())


def _facts(name: str, x: DataFrame) -> DataFrame:
    x = _passing(name, x)
    if name == "q3r":
        return x.select("account_id", "txn_id", "amount", "txn_time", F.col("seq").alias("txn_seq"))
    return x.select(
        F.col("approved_by_emp_id").alias("emp_id"), "txn_time", "txn_id", "account_id", "currency", "amount",
        F.col("seq").alias("txn_seq"))


def joined_rows(name: str, wire: Mapping[str, DataFrame], wait: str | None = None,
                watermark: str = WATERMARK_DELAY, salts: int = STREAM_SALTS, check_ids: bool = True,
                busy: DataFrame | None = None) -> DataFrame:
    """The rows of result ``name`` with the versions they come from, as a stream over the wire
    streams of ``transaction``, ``branch`` and the dimension between them. ``busy``: the only keys of that
    dimension that are dealt to several state partitions (default: all)."""
    kind, key, _ = PATHS[name]
    good = {k: decode(wire[k], k, check_ids)[0] for k in ("transaction", kind, "branch")}
    label = "city" if name == "q3r" else "branch_name"
    branch = good["branch"].select("branch_id", label, F.col("seq").alias("branch_seq"))
    dim = good[kind].select(key, "branch_id", F.col("seq").alias("dim_seq"))
    facts = _facts(name, good["transaction"])
    if wait is None:
        held = _met(facts, "txn_id", dim, key, salts, busy=busy)
        rows = _met(held, "txn_id", branch, "branch_id", BRANCH_SALTS)
    else:  # the bound lets transactions leave the one state they are in
        dim = dim.withColumn("dim_time", F.timestamp_millis("dim_seq")).withWatermark("dim_time", watermark)
        facts = facts.withWatermark("txn_time", watermark)
        bound = F.col("d_dim_time") <= F.col("txn_time") + F.expr(f"INTERVAL {wait}")
        placed = _met(dim, key, branch, "branch_id", salts).drop("branch_id")
        rows = _met(facts, "txn_id", placed, key, salts, bound, busy)
    if name == "q3r":
        return rows.select(B.hour_bucket("txn_time").alias("bucket_hour"), "city", "account_id", "txn_id", "amount",
                           *VERSIONS)
    return rows.select(F.col("emp_id").alias("employee_id"), B.quarter_label("txn_time").alias("quarter"), "txn_time",
                       "txn_id", "account_id", "currency", "amount", "branch_name", *VERSIONS)


def rejected(name: str, wire: Mapping[str, DataFrame], check_ids: bool = True) -> dict[str, DataFrame]:
    """Per kind the records that do not decode, with their reason, as streams for a sink of their own."""
    return {k: decode(wire[k], k, check_ids)[1] for k in ("transaction", PATHS[name][0], "branch")}


def start(name: str, sources: Mapping[str, str | DataFrame], out_path: str | None = None, checkpoint: str | None = None,
          max_files_per_trigger: int | None = None, available_now: bool = False, processing_time: str | None = None,
          partitions: int | None = None, **options):
    """Run result ``name`` over ``sources`` (kind -> folder of wire records, or wire stream). Each
    micro-batch replaces its own folder, so one that is run again adds nothing."""
    spark = SparkSession.getActiveSession()
    wire = {k: read_stream(spark, s, k, max_files_per_trigger=max_files_per_trigger) if isinstance(s, str) else s
            for k, s in sources.items()}
    if out_path is None:
        out_path = f"{checkpoint_dir(spark).rstrip('/')}/bankroll/joined/{name}"
    out_path = out_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = (joined_rows(name, wire, **options).writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", checkpoint or f"{out_path}_checkpoint"))
    return started(spark, writer, available_now, processing_time, partitions)


def read_view(spark: SparkSession, name: str, out_path: str) -> DataFrame:
    """Newest version of each row."""
    columns = R.ROLLUPS[name]({k: spark.createDataFrame([], SCHEMAS[k])
                               for k in ("transaction", "account", "branch", "employee")}).columns
    newest = latest_by_key(spark.read.parquet(out_path), RESULT_KEYS[name], list(VERSIONS))
    return newest.select(*columns)
