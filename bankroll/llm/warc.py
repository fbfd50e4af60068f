"""WARC archives: write, read back, and merge their capture indexes.

``write_archives`` writes a WARC/1.1 file series with Spark's text writer (one record a
row), so files are committed, shared and retried as any Spark output. Of captures with
equal payloads that with the largest key is a ``response``, the others are ``revisit``
records that name it and hold no body. ``read_archives`` parses the files by
Content-Length. ``merged_index`` sorts the captures of each archive file by (URL key,
timestamp, key) into a run, deals the runs' entries to key ranges, and merges the runs
that meet in a range with a loser tree, which gives globally ordered capture histories.
Ranges are cut by the whole sort key, so the captures of one URL may span ranges.

Cases: a null payload is empty; a null URL is written as an empty target; a null time as
the epoch; a null key as an empty key, below all others. Rows that repeat key and payload
are all responses if theirs is the largest key.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_dir, written

FILE_BYTES = 32 << 20       # payload bytes after which a task begins another archive file
REVISITS_BROADCAST = 1_000_000  # (key, digest, key) rows; beyond it the payloads are shuffled
RANGE_ROWS = 100_000        # index entries merged by one task
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def url_key(url: str) -> str:
    """Sort-friendly form of a URL: reversed host, then path and query, lower-cased; no
    scheme, ``www.`` or fragment."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return url.lower()
    host = host[4:] if host.startswith("www.") else host
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){tail}".lower()


def _record(key, url, when, payload: str, refers) -> str:
    """One record without the blank lines that close it. Header values are kept on one line."""
    url = "".join(c if c > " " else "%%%02X" % ord(c) for c in url or "")
    body = payload.encode("utf-8")
    digest = base32_sha1(body)
    name = "" if key is None else key
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
            f"WARC-Record-ID: <urn:capture:{name}:{digest}>", f"WARC-Date: {when}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
            f"Capture-Key: {name}", f"Payload-Length: {len(body)}"]
    if refers is None:
        http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
        head += ["Content-Type: application/http; msgtype=response",
                 f"Content-Length: {len(http) + len(body)}"]
        return CRLF.join(head) + CRLF + CRLF + http + payload
    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:capture:{refers}:{digest}>",
             f"Refers-To-Key: {refers}", "Content-Length: 0"]
    return CRLF.join(head) + CRLF + CRLF


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(series, value): records; ``series`` grows as files of FILE_BYTES fill up."""
    series = held = 0
    for batch in batches:
        values, numbers, waiting = [], [], 0
        columns = [batch.column(c).to_pylist() for c in ("key", "url", "when", "payload", "refers")]
        for row in zip(*columns):
            value = _record(*row)
            if held and held + len(value) > FILE_BYTES:
                series, held = series + 1, 0
            held += len(value)
            values.append(value)
            numbers.append(series)
            waiting += len(value)
            if waiting > FILE_BYTES // 4:
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(values)],
                                                 ["series", "value"])
                values, numbers, waiting = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(values, pa.string())],
                                         ["series", "value"])


def write_archives(captures: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", time_col: str = "captured_at",
                   least_bytes: int = 0) -> None:
    """Write the captures as gzip-compressed WARC files below ``path``. Payloads of fewer
    than ``least_bytes`` bytes are all responses."""
    captures = captures.select(
        F.col(key_col).alias("key"), F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
        F.date_format(F.coalesce(F.col(time_col), F.timestamp_seconds(F.lit(0))),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("when"))
    size = F.octet_length("payload")
    # digests only: the payloads themselves are not shuffled
    index = written(captures.filter(size >= least_bytes).select(
        "key", F.unhex(F.sha1(F.col("payload").cast("binary"))).alias("sha")), "warc-digests")
    most = (index.groupBy("sha").agg(F.max("key").alias("refers"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 and refers is not null").select("sha", "refers"))
    revisits = written(index.join(most, "sha").filter("key is null or key <> refers")
                       .select(F.col("key").alias("k"), F.col("sha").alias("s"), "refers").distinct(),
                       "warc-revisits")
    # beyond the bound the payloads are shuffled to their decisions
    side = F.broadcast(revisits) if revisits.count() <= REVISITS_BROADCAST else revisits
    sha = F.unhex(F.sha1(F.col("payload").cast("binary")))
    rows = (captures.withColumn("sha", sha)
            .join(side, F.col("key").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s")), "left")
            .select("key", "url", "when", "payload", "refers"))
    (rows.mapInArrow(_records, "series int, value string").write.partitionBy("series")
     .option("lineSep", CRLF * 2).option("compression", "gzip").text(path))


def _parse(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of each record of an unpacked archive."""
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at)
        lines = content[at:stop].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        header = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        end = stop + 4 + int(header["Content-Length"])
        if content[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} is cut short")
        yield at, end - at, header, content[stop + 4:end]
        at = end + 4


FIELDS = ("urlkey string, captured_at string, key string, url string, record_type string, "
          "payload_bytes long, payload_digest string, refers_to string, file string, "
          "offset long, length long")


def _captures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of each archive file, sorted: one run a file."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows = []
            data = content.as_buffer()
            name = path.as_py()
            for offset, length, header, block in _parse(zlib.decompress(data, 31) if name.endswith(".gz")
                                                        else data.to_pybytes()):
                kind, digest = header["WARC-Type"], header["WARC-Payload-Digest"].partition(":")[2]
                size = int(header["Payload-Length"])
                if kind == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    if len(payload) != size or base32_sha1(payload) != digest:
                        raise ValueError(f"{name}, offset {offset}: the payload is damaged")
                url = header["WARC-Target-URI"]
                rows.append((url_key(url), header["WARC-Date"], header["Capture-Key"], url, kind, size,
                             digest, header.get("Refers-To-Key"), name, offset, length))
            rows.sort(key=order)
            names = [f.split()[0] for f in FIELDS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)] if rows else
                [pa.array([], t) for t in TYPES], names)


TYPES = [pa.int64() if f.endswith("long") else pa.string() for f in FIELDS.split(", ")]


def order(row: tuple) -> tuple:
    """Sort key of an index entry: URL key, time, capture key, place."""
    return (row[0].encode("utf-8"), row[1], row[2], row[8], row[9])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (FIELDS): the entries of each file as a sorted run. Payload digests
    are checked. A file is handled whole; its size is bounded by the writer."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.txt.gz").load(path).select("path", "content"))
    return files.mapInArrow(_captures, FIELDS)


class LoserTree:
    """Merges sorted runs. Every inner node holds the loser of its match; the overall winner
    stands apart, so the next entry costs one comparison per level."""

    def __init__(self, runs: list[list], key) -> None:
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads = [self._head(k) for k in range(self.size)]
        self.losers = [0] * self.size
        self.winner = self._play(1)

    def _head(self, run: int):
        """(0, key, run) of the run's next entry; (1,) after its end, above all others."""
        if run < len(self.runs) and self.at[run] < len(self.runs[run]):
            return (0, self.key(self.runs[run][self.at[run]]), run)
        return (1,)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.heads[self.winner][0] == 0:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            node = (run + self.size) // 2
            while node:
                if self.heads[self.losers[node]] < self.heads[self.winner]:
                    self.losers[node], self.winner = self.winner, self.losers[node]
                node //= 2


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs that meet in one key range."""
    runs: dict[str, list] = {}
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(len(TYPES)))):
            runs.setdefault(row[8], []).append(row)
    for run in runs.values():
        # a run's entries may come in several pieces, in any order of the pieces
        if any(order(a) > order(b) for a, b in zip(run, run[1:])):
            run.sort(key=order)
    rows: list[tuple] = []
    place = 0
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["place"]
    for row in LoserTree(list(runs.values()), order):
        rows.append((*row, place))
        place += 1
        if len(rows) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [*TYPES, pa.int64()])], names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [*TYPES, pa.int64()])], names)


def merged_index(captures: DataFrame) -> DataFrame:
    """The entries of ``read_archives`` in global order: ``key_range`` and, in it, ``place``
    ascend with (URL key, time, key). The runs are written to the shared folder first, then
    each range merges its parts of them."""
    runs = written(captures, "warc-runs")
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, "urlkey", "captured_at", "key", "file", "offset")
    merged = dealt.mapInArrow(_merge, f"{FIELDS}, place long")
    return merged.withColumn("key_range", F.spark_partition_id())


def archive_and_index(captures: DataFrame, **columns: str) -> DataFrame:
    """Write the captures to a new archive below the shared folder and index it."""
    path = scratch_dir(captures.sparkSession, "warc")
    write_archives(captures, path, **columns)
    return merged_index(read_archives(captures.sparkSession, path))
