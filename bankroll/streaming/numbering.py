"""Order and gapless numbers per account on a stream.

Each account has the last number given and the transactions that wait. A transaction waits
until the watermark is past its time, as an earlier one may still come; then a timer
gives the waiting ones out in the order (time, id), numbered on from the last. So files in any order
give the numbers of the batch form (``plans.refresh.ordered_by_account``), as long as no row is later than
``delay``. What waits is bounded by the rows of an account within ``delay``.

Accounts share ``buckets`` of state by the hash of their id, as calls into Python and to the state store for each
account and micro-batch are too dear. A bucket keeps its waiting rows in packed parts and has one timer, at its
earliest waiting row; when it is due, all its rows are sorted and numbered at once and its last numbers are
written anew. A call takes tens of milliseconds, so take few buckets for few accounts, and more for more (a
bucket's waiting rows and last numbers must fit a Python worker); their number is fixed by the first start.

Cases: a row later than ``delay`` is behind numbers that were given out already and gets none (``late_rows``
finds them); equal times are ordered by id; a transaction delivered again while the first one waits counts once;
records that do not decode and rows without account or time are left out; rows newer than the
watermark wait on, over restarts too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import checkpoint_dir
from ..sources.records import decode
from .state import started

NUMBERED = "account_id string, txn_id string, txn_time timestamp, place long"
BUCKETS = 256
ORDER = ["account_id", "at", "txn_id"]


def _packed(rows: pd.DataFrame) -> bytes:
    part = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _unpacked(part: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(part).read_pandas()


class Numbering(StatefulProcessor):
    """The accounts of one bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "part binary")
        self.waiting = handle.getListState("waiting", "part binary")
        self.due = handle.getValueState("due", "at long")

    def _wait(self, first: int) -> None:
        """One timer, at the earliest waiting row."""
        due = self.due.get()[0] if self.due.exists() else None
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            self.due.update((first,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            self.waiting.appendValue((_packed(part[ORDER]),))
            earliest = int(part["at"].min())
            first = earliest if first is None else min(first, earliest)
        if first is not None:
            self._wait(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = pd.concat([_unpacked(p) for (p,) in self.waiting.get()]).drop_duplicates()
        ready, rest = rows[rows["at"] <= now].sort_values(ORDER), rows[rows["at"] > now]
        self.due.clear()
        if len(rest):
            self.waiting.put([(_packed(rest),)])
            self._wait(int(rest["at"].min()))
        else:
            self.waiting.clear()
        if not len(ready):
            return
        place = ready.groupby("account_id").cumcount() + 1
        last = None
        if self.last.exists():
            last = _unpacked(self.last.get()[0]).set_index("account_id")["place"]
            place = place + ready["account_id"].map(last).fillna(0).astype("int64")
        given = place.groupby(ready["account_id"]).max()
        last = given if last is None else pd.concat([last[~last.index.isin(given.index)], given])
        self.last.update((_packed(pd.DataFrame({"account_id": last.index, "place": last.to_numpy()})),))
        yield pd.DataFrame({"account_id": ready["account_id"], "txn_id": ready["txn_id"],
                            "txn_time": pd.to_datetime(ready["at"], unit="ms", utc=True), "place": place})

    def close(self) -> None:
        pass


def numbered(wire_txns: DataFrame, delay: str, check_ids: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """(account_id, txn_id, txn_time, place) of a wire transaction stream."""
    x = decode(wire_txns, "transaction", check_ids)[0].withWatermark("txn_time", delay)
    return (x.select(F.pmod(F.xxhash64("account_id"), F.lit(buckets)).alias("bucket"), "account_id", "txn_id", "txn_time",
                     F.unix_millis("txn_time").alias("at"))
            .groupBy("bucket")
            .transformWithStateInPandas(Numbering(), NUMBERED, "Append", "eventTime"))


def start(wire_txns: DataFrame, delay: str, out_path: str | None = None, checkpoint: str | None = None,
          available_now: bool = False, processing_time: str | None = None, partitions: int | None = None,
          check_ids: bool = True, buckets: int = BUCKETS):
    """Number the stream into ``out_path``, a folder per micro-batch that replaces itself."""
    spark = wire_txns.sparkSession
    out_path = (out_path or f"{checkpoint_dir(spark).rstrip('/')}/bankroll/numbered").rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = (numbered(wire_txns, delay, check_ids, buckets).writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", checkpoint or f"{out_path}_checkpoint"))
    return started(spark, writer, available_now, processing_time, partitions)


def read_view(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).select("account_id", "txn_id", "txn_time", "place")


def late_rows(txns: DataFrame, given: DataFrame, upto: str | F.Column) -> DataFrame:
    """Transactions up to the time ``upto`` (a watermark the query has passed) that got no number."""
    return txns.filter(F.col("txn_time") <= upto).join(given.select("txn_id"), "txn_id", "left_anti")
