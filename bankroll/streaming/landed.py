"""Landed-table stream refresh: regular-join semantics for the maintained tables (S6, S9,
T2, T3, T5-T9).

One streaming query reads the tagged union of the transaction stream and the dimension
changelogs. For micro-batch ``N`` the ``foreachBatch`` function

1. lands every kind in ``land/<kind>/batch_id=N`` (decoded, malformed rows to
   ``quarantine/<kind>/batch_id=N``), overwriting that folder, so a replayed batch
   replaces itself (replay safety);
2. derives the *before* state (``batch_id < N``) and *after* state (``batch_id <= N``)
   of every key as its newest version by ``(batch_id, seq)`` -- the compacted topic;
   a re-delivered transaction is one key, so it is counted once (T9);
3. per result table, finds the result keys the batch touches: the same batch rollup
   function applied to the affected transactions (new ones, and those whose account,
   employee or branch changed) under the before and the after state. A transaction
   that arrived before its account joins nothing before and its group after (T6);
   a branch that moved city touches the old city's and the new city's groups (T5);
4. writes ``results/<name>/batch_id=N``. Of a row result (a key depends on its row only): one
   row per touched key, with ``deleted = true`` where the key no longer has a result. Of an
   aggregate: the signed differences that the affected transactions make (``signed``), so the
   other rows of the touched groups are not read again.

Landed transactions are partitioned by ``batch_id`` and ``txn_month``. Hash-bucketed indexes
tell in which months a transaction, an account or an employee has rows. A batch of new
transactions reads itself only; one that delivers transactions again reads the months in
which these were. A re-delivered transaction may carry a corrected time:
where its month changes, a row that says so (``moved``) is landed in the old month, so the
newest versions within any set of months are right for these months.

Every ``snapshot_every`` batches dimension states, results and indexes are snapshotted, and
of the transactions the months written to since. Files read per batch are then bounded: for
each index bucket and month touched, those of one snapshot and of at most
``2 * snapshot_every`` batches, whatever the history's length.

The read view of a result is its newest row per result key without deleted rows, or the sum of
its differences (``read_view``); after every batch it equals the batch rollup over everything landed.
Late rows are kept (they revise their groups), as in the regular updating aggregation
the reference's SQL describes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import PRIMARY_KEYS, RESULT_KEYS, SCHEMAS
from ..operators.compaction import latest_by_key
from ..operators.joins import bounded_broadcast, measure
from ..plans import rollups as R
from ..session import checkpoint_dir
from ..sources.records import decode
from . import signed
from .sources import DIMENSIONS, KINDS, changelog_schema, read_stream, tagged_union

TXN_RESULTS = ("q1", "q2", "q3", "q3r", "q4", "q5b", "q6")
ALL_RESULTS = TXN_RESULTS + ("q5a", "q5")
# dimension tables each transaction result reads (a change there revises results)
DEPENDS = {"q1": (), "q2": (), "q3": ("account", "branch"), "q3r": ("account", "branch"),
           "q4": ("employee", "branch"), "q5b": ("account",), "q6": ("account",)}


# indexes over landed transactions: name -> id column
INDEXES = {"txn": "txn_id", "account": "account_id", "employee": "approved_by_emp_id"}
INDEX_BUCKETS = 64
INDEX_SCHEMA = "id string, txn_month string, batch_id long, bucket int"
REPEATS = "repeats"  # ids of transactions that were delivered more than once
LANDED_ROWS_PER_TASK = 2_000_000


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


class LandedRefresh:
    """Keeps the maintained tables under ``root`` fresh from one tagged stream."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 results: tuple[str, ...] = ALL_RESULTS, snapshot_every: int = 20,
                 check_ids: bool = True):
        """``root`` holds landed data, results and (by default) the stream checkpoint; it
        defaults to ``<spark.checkpoint.dir>/bankroll/landed`` -- a shared folder on a
        cluster -- and stays the same across restarts. Every ``snapshot_every`` batches
        (0: never) the dimension states and result tables are snapshotted, so later
        batches read one snapshot plus the newer batch folders instead of all history."""
        self.spark = spark
        root = root or f"{checkpoint_dir(spark).rstrip('/')}/bankroll/landed"
        self.root = root.rstrip("/")
        self.results = tuple(r for r in ALL_RESULTS if r in results)
        self.snapshot_every = snapshot_every
        self.check_ids = check_ids
        self._snaps: dict[tuple[str, str], list[int]] = {}
        self._months: dict[str, list[int]] | None = None

    # ------------------------------------------------------------------ storage
    def land_path(self, kind: str) -> str:
        return f"{self.root}/land/{kind}"

    def result_path(self, name: str) -> str:
        return f"{self.root}/results/{name}"

    def _landed(self, kind: str) -> DataFrame:
        """All landed versions of ``kind`` with ``batch_id`` (long) and ``seq``
        (transactions also carry their ``txn_month`` partition)."""
        parts = [T.StructField("seq", T.LongType()), T.StructField("batch_id", T.StringType())]
        if kind == "transaction":
            parts += [T.StructField("moved", T.BooleanType()), T.StructField("txn_month", T.StringType())]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMAS[kind].fields] + parts)
        df = (self.spark.read.schema(schema).parquet(self.land_path(kind))
              .withColumn("batch_id", F.col("batch_id").cast("long")))
        return df

    @staticmethod
    def _newest(df: DataFrame, kind: str) -> DataFrame:
        if kind == "transaction":  # a row outranks a "moved" mark of its own version
            live = F.when(F.col("moved"), 0).otherwise(1)
            out = latest_by_key(df.withColumn("live", live), "txn_id", ["batch_id", "seq", "live"])
            return out.filter("live = 1").drop("batch_id", "seq", "live", "moved", "txn_month")
        return latest_by_key(df, PRIMARY_KEYS[kind], ["batch_id", "seq"]).drop("batch_id", "seq")

    # ------------------------------------------------------------------ months
    def _index(self, name: str, ids: DataFrame, upto: int) -> DataFrame:
        """(id, txn_month) of the index ``name`` for ``ids`` as of batch ``upto``."""
        path = f"{self.root}/index/{name}"
        if not self._exists(path):
            return self.spark.createDataFrame([], "id string, txn_month string")
        ids = ids.select(F.col(ids.columns[0]).alias("id")).filter("id is not null")
        bucket = F.pmod(F.xxhash64("id"), F.lit(INDEX_BUCKETS)).cast("int")
        touched = [r[0] for r in ids.select(bucket).distinct().collect()]  # at most INDEX_BUCKETS
        rows = self.spark.read.schema(INDEX_SCHEMA).parquet(path)
        rows = self._with_snapshot("index", name, rows, upto).filter(F.col("bucket").isin(touched))
        return rows.join(ids, "id", "left_semi").select("id", "txn_month").distinct()

    def _months_of(self, name: str, ids: DataFrame, upto: int) -> list[str]:
        """The months (a calendar-bounded handful) in which the ids have transactions."""
        return sorted(r[0] for r in self._index(name, ids, upto).select("txn_month").distinct().collect())

    def _txns(self, months: list[str], upto: int) -> DataFrame:
        """Versions of the transactions of ``months`` as of batch ``upto``: of each month the
        newest snapshot and the batches after it."""
        rows = self._landed("transaction").filter(F.col("batch_id") <= upto)
        since: dict[int, list[str]] = {}
        for m in months:
            done = [u for u in self._month_snapshots().get(m, []) if u <= upto]
            since.setdefault(max(done, default=-1), []).append(m)
        parts = [] if since else [rows.filter(F.lit(False))]
        for u, own in since.items():
            here = rows.filter(F.col("txn_month").isin(own))
            if u >= 0:
                snap = (self.spark.read.schema(self._landed_schema())
                        .parquet(f"{self._snap_path('land', 'transaction')}/upto={u}"))
                here = here.filter(F.col("batch_id") > u).unionByName(
                    snap.filter(F.col("txn_month").isin(own)).select(*rows.columns))
            parts.append(here)
        return _union(parts)

    def _landed_schema(self) -> T.StructType:
        return self._landed("transaction").schema

    def _month_snapshots(self) -> dict[str, list[int]]:
        """Committed snapshots of each month (read once, then kept: this object alone writes)."""
        if self._months is None:
            marks = f"{self._snap_path('land', 'transaction')}/marks"
            self._months = {}
            if self._exists(marks):
                for r in self.spark.read.parquet(marks).select("m", "txn_month").collect():
                    self._months.setdefault(r["txn_month"], []).append(r["m"])
        return self._months

    def _snapshot_months(self, upto: int) -> None:
        """Snapshot the months written to since their last snapshot."""
        known = self._month_snapshots()
        last = max((u for us in known.values() for u in us), default=-1)
        dirty = [r[0] for r in self._landed("transaction").filter(
            (F.col("batch_id") > last) & (F.col("batch_id") <= upto)).select("txn_month").distinct().collect()]
        if not dirty:
            return
        base = self._snap_path("land", "transaction")
        live = F.when(F.col("moved"), 0).otherwise(1)
        # per month the newest version, marks of moved rows among them
        newest = latest_by_key(self._txns(dirty, upto).withColumn("live", live), ["txn_month", "txn_id"],
                               ["batch_id", "seq", "live"]).drop("live")
        newest.write.mode("overwrite").partitionBy("txn_month").parquet(f"{base}/upto={upto}")
        (self.spark.createDataFrame([(upto, m) for m in dirty], "m long, txn_month string")
         .coalesce(1).write.mode("overwrite").parquet(f"{base}/marks/upto={upto}"))
        for m in dirty:
            known.setdefault(m, []).append(upto)

    # ------------------------------------------------------------------ snapshots
    def _snap_path(self, area: str, name: str) -> str:
        return f"{self.root}/snap/{area}/{name}"

    def _snapshots(self, area: str, name: str) -> list[int]:
        """Committed snapshot batches of ``area/name`` (read once, then kept in memory:
        this object is the only writer)."""
        key = (area, name)
        if key not in self._snaps:
            marks = f"{self._snap_path(area, name)}/marks"
            self._snaps[key] = sorted(
                int(r[0]) for r in self.spark.read.parquet(marks).select("m").collect()
            ) if self._exists(marks) else []
        return self._snaps[key]

    def _snapshot_at(self, area: str, name: str, upto: int) -> int | None:
        """Newest committed snapshot of ``area/name`` covering batches <= ``upto``."""
        done = [m for m in self._snapshots(area, name) if m <= upto]
        return done[-1] if done else None

    def _with_snapshot(self, area: str, name: str, rows: DataFrame, upto: int) -> DataFrame:
        """Versioned rows of ``area/name`` as of batch ``upto``: the newest snapshot plus
        the batch folders after it (all batch folders when there is no snapshot)."""
        m = self._snapshot_at(area, name, upto)
        rows = rows.filter(F.col("batch_id") <= upto)
        if m is None:
            return rows
        snap = self.spark.read.schema(rows.schema).parquet(f"{self._snap_path(area, name)}/upto={m}")
        return snap.unionByName(rows.filter(F.col("batch_id") > m))

    def snapshot(self, upto: int) -> None:
        """Write the newest version per key of every dimension and result as of batch
        ``upto`` (a batch before the running one, so a replay of the running batch still
        finds its before-state), then its commit mark."""
        for kind in DIMENSIONS:
            rows = self._with_snapshot("land", kind, self._landed(kind), upto)
            snap = latest_by_key(rows, PRIMARY_KEYS[kind], ["batch_id", "seq"])
            self._write_snapshot("land", kind, snap, upto)
        if self._exists(self.land_path("transaction")):
            self._snapshot_months(upto)
        if self._exists(self.land_path(REPEATS)):
            ids = self._repeats(upto).withColumn("batch_id", F.lit(upto).cast("long"))
            self._write_snapshot("land", REPEATS, ids, upto)
        for name in INDEXES:
            path = f"{self.root}/index/{name}"
            if self._exists(path):
                rows = self._with_snapshot("index", name, self.spark.read.schema(INDEX_SCHEMA).parquet(path), upto)
                self._write_snapshot("index", name, rows.dropDuplicates(["id", "txn_month"]), upto, "bucket")
        for name in self.results:
            if self._has_results(name):
                rows = self._with_snapshot("results", name, self._results(name), upto)
                if name in signed.SIGNED:
                    snap = signed.folded(rows, name).withColumn("batch_id", F.lit(upto).cast("long"))
                    self._write_snapshot("results", name, snap.select(*rows.columns), upto)
                    continue
                snap = latest_by_key(rows, RESULT_KEYS[name], "batch_id", drop_deleted="deleted") \
                    .withColumn("deleted", F.lit(False))
                self._write_snapshot("results", name, snap.select(*rows.columns), upto)

    def _write_snapshot(self, area: str, name: str, df: DataFrame, upto: int, *parts: str) -> None:
        base = self._snap_path(area, name)
        df.write.mode("overwrite").partitionBy(*parts).parquet(f"{base}/upto={upto}")
        # commit mark, written after the snapshot is complete
        self.spark.createDataFrame([(upto,)], "m long").write.mode("overwrite") \
            .parquet(f"{base}/marks/upto={upto}")
        self._snaps.setdefault((area, name), [])
        self._snaps[(area, name)] = sorted(set(self._snaps[(area, name)]) | {upto})

    def _state(self, kind: str, upto: int) -> DataFrame:
        return self._newest(self._with_snapshot("land", kind, self._landed(kind), upto), kind)

    def _results(self, name: str) -> DataFrame:
        return (self.spark.read.parquet(self.result_path(name))
                .withColumn("batch_id", F.col("batch_id").cast("long")))

    # ------------------------------------------------------------------ stream wiring
    def stream(self, sources: dict[str, str | DataFrame], fmt: str = "json",
               max_files_per_trigger: int | None = None) -> DataFrame:
        """The tagged union of the sources: ``kind -> folder`` of wire records, or
        ``kind -> streaming DataFrame`` already in wire form."""
        streams = {k: (read_stream(self.spark, p, k, fmt, max_files_per_trigger)
                       if isinstance(p, str) else p) for k, p in sources.items()}
        return tagged_union(streams)

    def start(self, sources: dict[str, str | DataFrame], checkpoint: str | None = None,
              fmt: str = "json", max_files_per_trigger: int | None = None,
              available_now: bool = False, processing_time: str | None = None):
        checkpoint = checkpoint or f"{self.root}/_checkpoint"
        w = (self.stream(sources, fmt, max_files_per_trigger).writeStream
             .foreachBatch(self.process_batch).option("checkpointLocation", checkpoint))
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        return w.start()

    # ------------------------------------------------------------------ one micro-batch
    def _exists(self, path: str) -> bool:
        """Does a landed/result folder exist yet (resolved at analysis, no job)? Any error but
        a missing path is raised, a text that is no path as an ``AnalysisException`` too."""
        try:
            self.spark.read.schema("x int").parquet(path)
            return True
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        except IllegalArgumentException as e:
            raise AnalysisException(f"Not a path: {path}") from e

    def land(self, batch: DataFrame, batch_id: int, counts: dict[str, int] | None = None) -> None:
        """Land every kind of the micro-batch. A kind without rows in this batch is skipped
        once its folder exists (an empty batch folder would add nothing)."""
        for kind in KINDS:
            present = counts is None or counts.get(kind, 0) > 0
            if not present and self._exists(self.land_path(kind)):
                continue
            if kind not in batch.columns or not present:  # first batch: create the folder
                rows = self.spark.createDataFrame([], changelog_schema(kind))
            else:
                rows = batch.filter(F.col("kind") == kind).select(f"{kind}.*", "seq")
            good, bad = decode(rows, kind, self.check_ids)
            if kind == "transaction":
                self._land_transactions(good, batch_id, (counts or {}).get(kind, 0))
            else:
                good.write.mode("overwrite").parquet(f"{self.land_path(kind)}/batch_id={batch_id}")
            if present:
                bad.write.mode("overwrite").parquet(f"{self.root}/quarantine/{kind}/batch_id={batch_id}")

    def _land_transactions(self, good: DataFrame, n: int, count: int = 0) -> None:
        """Land by month, with a mark in each month that a transaction has left, and index."""
        path = f"{self.land_path('transaction')}/batch_id={n}"
        rows = good.withColumn("moved", F.lit(False)).withColumn("txn_month", F.date_format("txn_time", "yyyyMM"))
        # range-partitioned on (month, id): each task writes a contiguous slice (few files), and
        # a hot month -- usually the current one -- spreads over tasks
        slots = max(self.spark.sparkContext.defaultParallelism, -(-count // LANDED_ROWS_PER_TASK))
        (rows.repartitionByRange(slots, "txn_month", "txn_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
         .partitionBy("txn_month").parquet(path))
        # what follows reads a few columns of what was landed instead of the records again
        rows = self._landed("transaction").filter(F.col("batch_id") == n)
        again = self._kept("again", n, self._index("txn", rows.select("txn_id"), n - 1).toDF("txn_id", "old"))
        left = self._left_months(rows, again, n)
        if left is not None:
            left.repartitionByRange(slots, "txn_month", "txn_id").select(
                "txn_id", "seq", "moved", "txn_month").write.mode("append").partitionBy("txn_month").parquet(path)
        for name, column in INDEXES.items():
            ids = self._landed("transaction").filter((F.col("batch_id") == n) & ~F.col("moved")).select(
                F.col(column).alias("id"), "txn_month").filter("id is not null")
            if name != "txn":  # an id that comes twice is rare there, and its readers take it once
                ids = ids.distinct()
            (ids.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(INDEX_BUCKETS)).cast("int"))
             .repartition("bucket").write.mode("overwrite")
             .option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("bucket")
             .parquet(f"{self.root}/index/{name}/batch_id={n}"))

    def _left_months(self, rows: DataFrame, again: DataFrame, n: int) -> DataFrame | None:
        """Keep the ids that batch ``n`` delivers not for the first time or more than once, and return
        the marks of the months that these have left (None if there are no such ids)."""
        known = self._exists(self.land_path(REPEATS))
        seen = rows.select("txn_id", "seq", "txn_month", F.lit(True).alias("new")).unionByName(again.select(
            "txn_id", F.lit(None).cast("long").alias("seq"), F.col("old").alias("txn_month"), F.lit(False).alias("new")))
        ids = seen.select("txn_id")
        if not known and n:  # landed before this was kept: count all there is, once
            ids = ids.unionByName(self._landed("transaction").filter((F.col("batch_id") < n)).select("txn_id"))
        repeats = ids.groupBy("txn_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("txn_id")
        path = f"{self.land_path(REPEATS)}/batch_id={n}"
        repeats.write.mode("overwrite").parquet(path)
        repeats = self.spark.read.schema(repeats.schema).parquet(path)
        if not measure(repeats, ["txn_id"])[0]:
            return None
        mine = seen.join(bounded_broadcast(repeats)[0], "txn_id", "left_semi")
        per_id = mine.groupBy("txn_id").agg(
            F.max(F.when(F.col("new"), F.struct("seq", "txn_month"))).alias("last"),
            F.collect_set("txn_month").alias("months")).filter("last is not null")  # a handful of months
        return per_id.select("txn_id", "last", F.explode("months").alias("old")).filter("old <> last.txn_month").select(
            "txn_id", "last.seq", F.lit(True).alias("moved"), F.col("old").alias("txn_month"))

    def _repeats(self, upto: int) -> DataFrame:
        """Ids of the transactions that came more than once up to batch ``upto``; all others have one version."""
        rows = self.spark.read.schema("txn_id string, batch_id long").parquet(self.land_path(REPEATS))
        return self._with_snapshot("land", REPEATS, rows, upto).select("txn_id").distinct()

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        # rows per kind: a handful of (kind, count) rows. The batch is not kept beside its landed
        # form: its source gives the same records each time it is read.
        counts = {r["kind"]: r["n"] for r in
                  batch.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.land(batch, batch_id, counts)
        self.refresh(batch_id, counts)
        if self.snapshot_every and batch_id > 0 and batch_id % self.snapshot_every == 0:
            self.snapshot(batch_id - 1)

    def refresh(self, n: int, counts: dict[str, int] | None = None) -> None:
        """Bring every result up to batch ``n``. ``counts`` (rows per kind in the batch)
        lets results whose inputs did not change skip their recompute; ``None`` means
        recompute everything the batch could touch."""
        def has(kind: str) -> bool:
            return counts is None or counts.get(kind, 0) > 0

        if not any(has(k) for k in ("transaction", "account", "branch", "employee")):
            return
        before = {k: self._state(k, n - 1) for k in DIMENSIONS}
        after = {k: self._state(k, n) for k in DIMENSIONS}
        changed = {k: self._landed(k).filter(F.col("batch_id") == n).select(*PRIMARY_KEYS[k])
                   for k in DIMENSIONS}
        again_months: list[str] = []
        if has("transaction"):
            again = self.spark.read.schema("txn_id string, old string").parquet(f"{self.root}/touched/again/batch_id={n}")
            again_months = sorted(r[0] for r in again.select("old").distinct().collect())

        # accounts / employees whose own row or whose branch row changed in this batch: their
        # transactions are revisited in the months in which they have any (a batch without
        # dimension rows, the common case, skips this)
        dim_rows = {k: has(k) for k in ("account", "branch", "employee")}
        moved_branch = changed["branch"]
        ids = {"account": None, "employee": None}
        for kind, key in (("account", "account_id"), ("employee", "emp_id")):
            if dim_rows[kind] or dim_rows["branch"]:
                parts = [changed[kind]]
                if dim_rows["branch"]:
                    parts += [s[kind].join(moved_branch, "branch_id", "left_semi").select(key) for s in (before, after)]
                ids[kind] = _union(parts).distinct()

        row_results = [r for r in self.results if r in TXN_RESULTS and r not in signed.SIGNED]
        new_rows = by_account = by_employee = None
        if row_results:
            if has("transaction"):
                new_rows = self._landed("transaction").filter(F.col("batch_id") == n)
                if again_months:  # earlier versions of the transactions that come again
                    new_rows = new_rows.unionByName(
                        self._txns(again_months, n - 1).join(again.select("txn_id").distinct(), "txn_id", "left_semi")
                        .select(*new_rows.columns))
            if ids["account"] is not None and any("account" in DEPENDS[r] for r in row_results):
                by_account = self._revisited("account", ids["account"], n)
            if ids["employee"] is not None and any("employee" in DEPENDS[r] for r in row_results):
                by_employee = self._revisited("employee", ids["employee"], n)

        touched_out: dict[str, DataFrame] = {}
        signed_months: dict[bool, list[str]] = {}
        for name in self.results:
            if name not in signed.SIGNED:
                continue
            revisit = ids["account"] if dim_rows["account"] or ("branch" in DEPENDS[name] and dim_rows["branch"]) else None
            if revisit is None and not has("transaction"):
                continue
            if revisit is not None and True not in signed_months:
                signed_months[True] = self._months_of("account", revisit, n - 1)
            months = sorted({*again_months, *(signed_months[True] if revisit is not None else ())})
            rows = self._by_role(name, n, months, has("transaction"), revisit is not None)
            change = signed.change(name, rows, before, after, revisit)
            path = f"{self.result_path(name)}/batch_id={n}"
            change.write.mode("overwrite").parquet(path)
            touched_out[name] = self.spark.read.schema(change.schema).parquet(path).select(
                *RESULT_KEYS[name]).distinct()
        for name in row_results:
            rows = [new_rows] if new_rows is not None else []
            if "account" in DEPENDS[name] and by_account is not None:
                rows.append(by_account)
            if "employee" in DEPENDS[name] and by_employee is not None:
                rows.append(by_employee)
            if not rows:  # nothing this result reads changed in this batch
                continue
            affected = _union(rows)   # every version of every affected transaction
            old = self._newest(affected.filter(F.col("batch_id") < n), "transaction")
            new = self._newest(affected, "transaction")
            fn, keys = R.ROLLUPS[name], RESULT_KEYS[name]  # a key depends on its row only
            result = fn({"transaction": new, **after})
            touched = self._kept(name, n, fn({"transaction": old, **before}).select(*keys)
                                 .unionByName(result.select(*keys)).distinct())
            self._write(name, touched, result, n)
            touched_out[name] = touched

        if "q5a" in self.results and has("account"):
            acc_b = before["account"].join(changed["account"], "account_id", "left_semi")
            acc_a = after["account"].join(changed["account"], "account_id", "left_semi")
            touched = self._kept("q5a", n, acc_b.select("customer_id")
                                 .unionByName(acc_a.select("customer_id")).distinct())
            scope = after["account"].join(touched, "customer_id", "left_semi")
            self._write("q5a", touched, R.q5a_active_accounts({"account": scope}), n)
            touched_out["q5a"] = touched

        # Q5 needs both inputs stored (before that it is empty, and so are its old rows)
        if ("q5" in self.results and {"q5a", "q5b"} & set(touched_out)
                and self._has_results("q5a") and self._has_results("q5b")):
            customers = _union([touched_out[k].select("customer_id")
                                for k in ("q5a", "q5b") if k in touched_out]).distinct()
            q5a_now = self.read_view("q5a", upto=n, customers=customers)
            q5b_now = self.read_view("q5b", upto=n, customers=customers)
            keys = RESULT_KEYS["q5"]
            parts = [q5b_now.select(*keys)] + (
                [touched_out["q5b"].select(*keys)] if "q5b" in touched_out else [])
            if self._has_results("q5"):
                parts.append(self.read_view("q5", upto=n - 1, customers=customers).select(*keys))
            touched = _union(parts).distinct()
            out = R.q5_high_value_customers({}, q5a=q5a_now, q5b=q5b_now)
            self._write("q5", touched, out, n)

    # ------------------------------------------------------------------ helpers
    def _by_role(self, name: str, n: int, months: list[str], delivered: bool, revisited: bool) -> DataFrame:
        """The columns that ``name`` reads of the transactions of ``months`` and of batch ``n``, with their ``role``:
        ``new`` and ``old`` versions of what batch ``n`` delivered, and the ``rest`` (only if ``revisited``).
        A transaction that came once is its own newest version; only the others are compared by id."""
        columns = [c for c in signed.COLUMNS[name] if c != "txn_id"]
        live = F.when(F.col("moved"), 0).otherwise(1).alias("live")
        parts = [self._landed("transaction").filter(F.col("batch_id") == n)] if delivered else []
        parts += [self._txns(months, n - 1)] if months else []
        if not parts:
            parts = [self._landed("transaction").filter(F.lit(False))]
        rows = _union([p.select("txn_id", *columns, "batch_id", "seq", live) for p in parts])
        role = F.when(F.col("batch_id") == n, F.lit("new")).otherwise(F.lit("rest")).alias("role")
        repeats = self._repeats(n)
        found = measure(repeats, ["txn_id"])[0]
        singles, several = rows, None
        if found:
            known, small = bounded_broadcast(repeats)
            several = rows.join(known, "txn_id", "left_semi") if small else rows
            singles = rows.join(known, "txn_id", "left_anti") if small else None
        out = [] if singles is None else [singles.select(role, "txn_id", *columns)]
        if several is not None:
            row, version = F.struct("live", *columns), F.struct("batch_id", "seq", "live")
            per_id = several.groupBy("txn_id").agg(
                F.max("batch_id").alias("last"), F.max_by(row, version).alias("now"),
                F.max_by(row, F.when(F.col("batch_id") < n, version)).alias("was"))
            touched = F.col("last") == n
            both = F.array(F.struct(F.when(touched, F.lit("new")).otherwise(F.lit("rest")).alias("role"),
                                    F.col("now").alias("row")),
                           F.struct(F.lit("old").alias("role"), F.when(touched, F.col("was")).alias("row")))
            out.append(per_id.select("txn_id", F.inline(both)).filter("row.live = 1").select(
                "role", "txn_id", *[F.col(f"row.{c}").alias(c) for c in columns]))
        rows = _union(out)
        return rows if revisited else rows.filter("role <> 'rest'")

    def _kept(self, name: str, n: int, touched: DataFrame) -> DataFrame:
        """The touched keys, written once and read by every use of them."""
        path = f"{self.root}/touched/{name}/batch_id={n}"
        touched.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(touched.schema).parquet(path)

    def _revisited(self, index: str, ids: DataFrame, n: int) -> DataFrame | None:
        """All versions of the ids' transactions; None if they have none."""
        column = INDEXES[index]
        ids = ids.toDF(column).distinct()
        months = self._months_of(index, ids, n)
        if not months:
            return None
        rows = self._txns(months, n)
        mine = rows.join(ids, column, "left_semi").select("txn_id").distinct()
        return rows.join(mine, "txn_id", "left_semi")

    def _write(self, name: str, touched: DataFrame, result: DataFrame, n: int) -> None:
        keys = RESULT_KEYS[name]
        # the left join from the touched keys keeps exactly those keys (result rows of
        # other keys fall away), marking keys without a result as deleted
        present = result.withColumn("__present", F.lit(True))
        out = (touched.join(present, keys, "left")
               .withColumn("deleted", F.col("__present").isNull()).drop("__present"))
        out.write.mode("overwrite").parquet(f"{self.result_path(name)}/batch_id={n}")

    def _has_results(self, name: str) -> bool:
        return self._exists(self.result_path(name))

    def increments(self, name: str, upto: int = 1 << 62) -> DataFrame:
        """The signed differences (``signed``) that result ``name`` is the sum of, as of batch ``upto``."""
        return self._with_snapshot("results", name, self._results(name), upto)

    def read_view(self, name: str, upto: int | None = None,
                  customers: DataFrame | None = None) -> DataFrame:
        """Current content of result ``name``: newest row per result key, deleted rows
        dropped (optionally as of batch ``upto`` and for some customers only). Before the
        first write of ``name`` this is an empty table with the result's schema."""
        empty = R.ROLLUPS[name]({k: self.spark.createDataFrame([], SCHEMAS[k])
                                 for k in ("transaction", "account", "branch", "employee")})
        if not self._has_results(name):
            return empty
        df = self._results(name)
        upto = upto if upto is not None else (1 << 62)
        df = self._with_snapshot("results", name, df, upto)
        if customers is not None:
            df = df.join(customers, "customer_id", "left_semi")
        if name in signed.SIGNED:
            return signed.totals(df, name).select(*empty.columns)
        newest = latest_by_key(df, RESULT_KEYS[name], "batch_id", drop_deleted="deleted")
        return newest.select(*empty.columns)
