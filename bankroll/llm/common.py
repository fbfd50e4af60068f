"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir

BATCH_BYTES = 4 << 20  # text handled at once by one Python worker


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again: cuts
    the lineage, and survives the loss of executors. The schema stays as it is."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(batches: Iterable[pa.RecordBatch], column: str,
                 max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``max_bytes`` in each; a longer
    text stands alone, whole."""
    for batch in batches:
        sizes = np.diff(string_buffers(batch.column(column))[1])
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column without copying; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                            count=column.offset + len(column) + 1)[column.offset:]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists from their joined values and their lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start..start+length-1 of each pair, joined."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep].astype(np.int64), lengths[keep]
    heads = np.r_[0, np.cumsum(lengths)[:-1]]
    out[heads] = np.r_[starts[0], starts[1:] - (starts[:-1] + lengths[:-1] - 1)]
    return np.cumsum(out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HELD: dict[str, tuple[object, object]] = {}


def held(kind: str, key: object, make):
    """``make()``, kept by this Python worker until another table is asked for: a reused worker
    holds one table of one operator, never those of the stages before."""
    if kind not in _HELD or _HELD[kind][0] != key:
        _HELD.clear()
        _HELD[kind] = (key, make())
    return _HELD[kind][1]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors (once per application), so that they need
    no copy of it on their own path."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="bankroll-code-")  # read by the driver only
        path = os.path.join(folder, "bankroll_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for at, _, names in os.walk(os.path.join(top, "bankroll")):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        z.write(full, os.path.relpath(full, top))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark
