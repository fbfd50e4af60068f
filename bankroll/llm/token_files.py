"""Token-id files: ids of all documents one after the other, with Elias-Fano boundaries.

The documents are dealt to ranges of ascending id and encoded there. Each range becomes
segments of about ``SEGMENT_IDS`` ids, written by Spark's text writer (a segment is one row;
its bytes are written as they are, a line feed closes it), so files are committed, shared and
retried as any Spark output. A segment holds

* a header of fixed size (``HEADER``; all numbers are little-endian),
* the Elias-Fano form of its documents' ends among its ids,
* the documents' names: integers in Elias-Fano form above the least of them, or UTF-8 text
  with Elias-Fano ends; documents without a name come first and are only counted,
* the ids, two or four bytes each, as the vocabulary asks for.

Elias-Fano splits each of the ``n`` ascending numbers below ``u`` into ``log2(u / n)`` low bits, packed,
and a high part, written as a unary-coded bit array: about ``2 + log2(u / n)`` bits a number.
``select`` finds number ``i`` by the count of ones before each block of 512 bits (32-bit
counts, as a segment is small), then by the ones of the block's words. Offsets within the whole
corpus are a segment's base (``catalog``, one row a segment) plus the selected number, so no
table of 64-bit offsets exists.

Equal to the tokenizers library: texts are parted on their UTF-8 bytes, a batch at once, and each
distinct word of a batch (a part between spaces, tabs and line feeds; the model drops white space
and joins nothing over it) is looked up once. A word of plain Latin letters, with punctuation of
ASCII after them or none, is lower-cased here and goes to the library's model at once; every other
word goes through the library's whole pipeline. Workers remember words up to ``KNOWN_BYTES``.

Cases: a null text is empty (the end id alone). Rows that repeat an id are all written, in
the order of their texts' hashes. A null id is a name of its own kind, before all others. A very
long text is one document in one segment. An empty table gives an empty archive. Extra columns
are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, list_array, ranges, scratch_dir, string_buffers, text_batches, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SEGMENT_IDS = 1 << 20        # ids after which a segment ends
SEGMENT_DOCS = 1 << 17       # and documents
SEGMENTS_PER_FILE = 4
RANGE_BYTES = 128 << 20      # text of one range, if there are at least two ranges a task slot
LEAST_RANGE_BYTES = 8 << 20
CATALOG_BROADCAST = 1_000_000  # segments; beyond it the catalog is joined by a shuffle
KNOWN_BYTES = 48 << 20
WORD_BYTES = 200             # of a known word: its text, its ids, its entry
LONGEST_KNOWN = 64           # characters of a word that is remembered
MAGIC = b"EFIDSEG1"
# magic, range, number in the range, bytes of an id, names are text, documents, documents without a
# name, ids, least name, bytes of the ends, bytes of the names
HEADER = struct.Struct("<8sIIBB2xIIQqQQ")
BLOCK_BITS = 512


class EliasFano:
    """Ascending numbers in near-minimal space, with select."""

    HEAD = struct.Struct("<IB3xII")  # numbers, low bits, bytes of the low part, blocks of the high part

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, before: np.ndarray) -> None:
        self.n, self.bits, self.low, self.high, self.before = n, bits, low, high, before

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        cells = np.zeros((n, bits), np.uint8)
        for k in range(bits):
            cells[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        low = np.packbits(cells.ravel(), bitorder="little")
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = -(-(int(place[-1]) + 1 if n else 0) // BLOCK_BITS) * BLOCK_BITS
        ones = np.zeros(size, np.uint8)
        ones[place] = 1
        counts = ones.reshape(-1, BLOCK_BITS).sum(1, dtype=np.int64)
        return cls(n, bits, low, np.packbits(ones, bitorder="little").view("<u8"),
                   (np.cumsum(counts) - counts).astype("<u4"))

    def to_bytes(self) -> bytes:
        return b"".join([self.HEAD.pack(self.n, self.bits, len(self.low), len(self.before)), self.low.tobytes(),
                         self.high.tobytes(), self.before.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bits, size, blocks = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        low = np.frombuffer(data, np.uint8, size, at)
        high = np.frombuffer(data, "<u8", blocks * (BLOCK_BITS // 64), at + size)
        return cls(n, bits, low, high, np.frombuffer(data, "<u4", blocks, at + size + high.nbytes))

    @property
    def nbytes(self) -> int:
        return self.HEAD.size + self.low.nbytes + self.high.nbytes + self.before.nbytes

    def select(self, which: np.ndarray) -> np.ndarray:
        """The numbers at the places ``which``."""
        which = np.asarray(which, np.int64)
        out = np.zeros(len(which), np.uint64)
        for a in range(0, len(which), 1 << 15):
            out[a:a + (1 << 15)] = self._select(which[a:a + (1 << 15)])
        return out

    def _select(self, i: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.before, i, side="right") - 1
        rest = i - self.before[block]
        words = self.high.reshape(-1, BLOCK_BITS // 64)[block]
        ones = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        at = (ones <= rest[:, None]).sum(1)
        rows = np.arange(len(i))
        rest = rest - np.where(at > 0, ones[rows, at - 1], 0)
        bits = np.unpackbits(np.ascontiguousarray(words[rows, at]).view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        inside = (np.cumsum(bits, axis=1) <= rest[:, None]).sum(1)
        high = (block * BLOCK_BITS + at * 64 + inside - i).astype(np.uint64)
        if not self.bits:
            return high
        first = i * self.bits
        padded = np.zeros(len(self.low) + 16, np.uint8)
        padded[:len(self.low)] = self.low
        eights = np.ndarray((len(self.low) + 8,), "<u8", padded, 0, (1,))
        byte, shift = first >> 3, (first & 7).astype(np.uint64)
        low = eights[byte] >> shift
        # the ninth byte, where a number reaches into it
        over = shift > 0
        low[over] |= padded[byte[over] + 8].astype(np.uint64) << (np.uint64(64) - shift[over])
        return (high << np.uint64(self.bits)) | (low & np.uint64((1 << self.bits) - 1))


class Segment:
    """One segment of a file, read by select."""

    def __init__(self, data: memoryview) -> None:
        (magic, self.range, self.number, self.width, self.text, self.docs, self.nameless, self.size, self.least,
         ends, names) = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no segment begins here")
        at = HEADER.size
        self.bounds = EliasFano.from_bytes(data[at:at + ends])
        self._names = data[at + ends:at + ends + names]
        first = at + ends + names
        self.stop = first + self.size * self.width
        if len(data) <= self.stop or data[self.stop] != 10:
            raise ValueError("the segment is cut short")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.size, first)

    def ends(self, which: np.ndarray) -> np.ndarray:
        return self.bounds.select(which).astype(np.int64)

    def starts(self, which: np.ndarray) -> np.ndarray:
        which = np.asarray(which, np.int64)
        return np.where(which > 0, self.ends(np.maximum(which - 1, 0)), 0)

    def names(self) -> list:
        none = [None] * self.nameless
        if self.docs == self.nameless:
            return none
        if not self.text:
            above = EliasFano.from_bytes(self._names).select(np.arange(self.docs - self.nameless))
            return none + (above.view(np.int64) + np.int64(self.least)).tolist()
        ends = EliasFano.from_bytes(self._names)
        stops = ends.select(np.arange(ends.n)).astype(np.int64).tolist()
        data = bytes(self._names[ends.nbytes:])
        return none + [data[a:b].decode("utf-8") for a, b in zip([0] + stops, stops)]


def _pack(place: tuple[int, int], names: list, sizes: list[int], parts: list[bytes], width: int) -> bytes:
    """A segment of documents in their order; documents without a name come first."""
    named = [x for x in names if x is not None]
    text, least, block = False, 0, b""
    if named and isinstance(named[0], str):
        text = True
        raw = [x.encode("utf-8") for x in named]
        block = EliasFano.of(np.cumsum([len(x) for x in raw])).to_bytes() + b"".join(raw)
    elif named:
        least = named[0]
        block = EliasFano.of((np.array(named, np.int64) - np.int64(least)).view(np.uint64)).to_bytes()
    ends = EliasFano.of(np.cumsum(sizes)).to_bytes()
    head = HEADER.pack(MAGIC, *place, width, text, len(names), len(names) - len(named), sum(sizes), least,
                       len(ends), len(block))
    return b"".join([head, ends, block, *parts])


def segments(data: bytes) -> Iterator[Segment]:
    view, at = memoryview(data).cast("B"), 0
    while at < len(view):
        segment = Segment(view[at:])
        yield segment
        at += segment.stop + 1


# ------------------------------------------------------------------ encoding
# Letters whose lower case and normal form the library and Python give alike: Latin ones up to U+024F
# (but for U+0130, whose lower case is two characters), and punctuation that may close a word: of ASCII,
# it is a part of its own wherever it follows a letter
LETTERS = r"A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
_PLAIN = re.compile(rf"([{LETTERS}]+)([!-/:-@\[-`{{-~]*)")
# among words on lines of their own, those that are small letters alone (in Latin-1: each its own lower case)
_SMALL = re.compile(r"^[a-zß-öø-ÿ]+$", re.M)


def _bytes_in(some: bytes) -> np.ndarray:
    """For each byte, whether it is one of these."""
    out = np.zeros(256, bool)
    out[list(some)] = True
    return out


_SPACES = _bytes_in(b" \n\t")
_CLOSING = _bytes_in(b".,;:!?")
_ASCII_LETTERS = _bytes_in(bytes(c for c in range(128) if chr(c).isalpha()))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)  # A-Z alone
_COMBINING = 0xCC  # first byte of U+0300, below which no character joins with the one before it


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Parts of texts (UTF-8 bytes, offsets) whose ids are independent of each other, and how many of
    them come before each offset. One closing mark after an ASCII letter is a part of its own. Small
    letters replace A-Z where that is a matter of each letter, and can make no special token's name."""
    space = _SPACES[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins or ends here
    edge[offsets] = True
    marks = np.flatnonzero(_CLOSING[data])
    marks = marks[edge[marks + 1] | space[np.minimum(marks + 1, len(data) - 1)]]
    marks = marks[~edge[marks] & _ASCII_LETTERS[data[marks - 1]]]
    first = edge[:-1]
    first[1:] |= space[:-1]
    first[marks] = True
    starts = np.flatnonzero(first & ~space)
    if not len(starts):
        return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    as_is = data >= _COMBINING
    as_is[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if as_is.any():
        whole = np.repeat(np.logical_or.reduceat(as_is, starts), np.diff(starts, append=len(data)))
        low[starts[0]:][whole] = data[starts[0]:][whole]
    kept = ~space
    ends = np.cumsum(kept, dtype=np.int64)
    bounds = np.append(ends[starts] - 1, ends[-1])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(low[kept]))
    return words, np.searchsorted(starts, offsets)


class WordIds:
    """Ids of texts, word by word."""

    def __init__(self, tokenizer: bytes) -> None:
        # a task has one core: the library's own threads would only contend for it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(tokenizer.decode("utf-8"))
        self.model = self.whole.model
        # the model reads UTF-8 bytes as characters of the library's: ASCII letters stand for themselves
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {c.lower() for c in map(chr, range(0x80, 0x250)) if _PLAIN.fullmatch(c)}
        self.as_bytes = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in letters})
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        self.code = f"<u{self.width}"
        self.tails: dict[str, bytes] = {"": b""}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _cores(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(word, ids) of words of plain letters, lower-cased already: each is one sequence of the model's."""
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for word in words:
            ids += [t.id for t in tokenize(word if word.isascii() else word.translate(self.as_bytes))]
            ends.append(len(ids) * self.width)
        data = np.array(ids, self.code).tobytes()
        return zip(words, map(data.__getitem__, map(slice, ends, ends[1:])))

    def _pipeline(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.code).tobytes()
                for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        small = _SMALL.findall("\n".join(words))
        out = dict(self._cores(small))
        plain, other = [], []
        for word in words if len(small) < len(words) else ():
            if word in out:
                continue
            m = _PLAIN.fullmatch(word)
            if m is None:
                other.append(word)
            else:
                plain.append((word, m[1].lower(), m[2]))
        if len(self.tails) > 10_000:
            self.tails = {"": b""}
        tails = list({t for _, _, t in plain} - self.tails.keys())
        self.tails.update(zip(tails, self._pipeline(tails)))
        cores = dict.fromkeys(c for _, c, _ in plain)
        cores.update((c, out.get(c) or self.known.get(c) or self.before.get(c)) for c in cores)
        cores.update(self._cores([c for c, ids in cores.items() if ids is None]))
        out.update((w, cores[c] + self.tails[t]) for w, c, t in plain)
        out.update(zip(other, self._pipeline(other)))
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. Known words are held in two halves: those met since the last change
        of halves, and those met in the time before."""
        if WORD_BYTES * len(self.known) > KNOWN_BYTES // 2:
            self.known, self.before = {}, self.known
        new = [w for w in words if w not in self.known]
        here = {w: self.before[w] for w in new if w in self.before}
        here |= self._learn([w for w in new if w not in here])
        self.known |= here
        ids = list(map(self.known.__getitem__, words))
        for w in [w for w in here if len(w) > LONGEST_KNOWN]:
            del self.known[w]
        return ids

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text, joined as little-endian numbers. A null is empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        words, before = words_of(*string_buffers(texts))
        coded = words.dictionary_encode()
        number = coded.indices.to_numpy()
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        of_word = sizes[number]
        data = np.frombuffer(b"".join(ids), self.code)[ranges((np.cumsum(sizes) - sizes)[number], of_word)].tobytes()
        ends = (np.append(0, np.cumsum(of_word))[before] * self.width).tolist()
        return list(map(data.__getitem__, map(slice, ends, ends[1:])))


def _encoder(tokenizer: bytes, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held("word ids", tokenizer, lambda: WordIds(tokenizer))
        end = np.array([end_id], words.code).tobytes()
        range_no = TaskContext.get().partitionId()
        names, sizes, parts, ids, number = [], [], [], 0, 0
        for batch in text_batches(batches, "text"):
            for name, data in zip(batch.column("id").to_pylist(), words.encode(batch.column("text"))):
                n = len(data) // words.width + 1
                if names and (ids + n > SEGMENT_IDS or len(names) >= SEGMENT_DOCS):
                    yield _row(_pack((range_no, number), names, sizes, parts, words.width))
                    names, sizes, parts, ids, number = [], [], [], 0, number + 1
                names.append(name)
                sizes.append(n)
                parts += (data, end)
                ids += n
        if names:
            yield _row(_pack((range_no, number), names, sizes, parts, words.width))
    return run


def _row(segment: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([segment], pa.binary())], ["segment"])


# ------------------------------------------------------------------ files
def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Write the ids of all documents below ``path``: ``segments`` and ``catalog``. Ids are
    integers or text. The tokenizer file (a few MB) is read by the driver and sent with the job."""
    with open(tokenizer, "rb") as f:
        data = f.read()
    spark = docs.sparkSession
    kind = T.StringType() if isinstance(docs.schema[id_col].dataType, T.StringType) else T.LongType()
    rows = docs.select(F.col(id_col).cast(kind).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // RANGE_BYTES),
                min(-(-size // LEAST_RANGE_BYTES), 2 * spark.sparkContext.defaultParallelism))
    # equal ids are dealt and ordered by their texts' hashes, then by their place: no id is one task
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("n")]
    dealt = (rows.withColumn("h", F.xxhash64("text")).withColumn("n", F.monotonically_increasing_id())
             .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text"))
    (dealt.mapInArrow(_encoder(data, end_id), "segment binary")
     .select(F.col("segment").cast("string").alias("value"))  # the bytes stay as they are
     .write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(f"{path}/segments"))
    _catalog(spark, path).write.parquet(f"{path}/catalog")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/segments").select("content")


def _heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(s.range, s.number, s.docs, s.size) for content in batch.column("content")
                for s in segments(content.as_buffer())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                                         ["range", "number", "docs", "ids"])


def _catalog(spark: SparkSession, path: str) -> DataFrame:
    """(range, number, docs, ids, first_doc, first_id): one row a segment."""
    heads = written(_files(spark, path).mapInArrow(_heads, "range long, number long, docs long, ids long"),
                    "ids-heads")
    # one row a range comes to the driver
    totals = heads.groupBy("range").agg(F.sum("docs"), F.sum("ids")).orderBy("range").collect()
    sums = np.cumsum([[0, 0]] + [[r[1], r[2]] for r in totals], axis=0).tolist()
    bases = spark.createDataFrame([(r["range"], d, i) for r, (d, i) in zip(totals, sums)],
                                  "r long, d long, i long")
    before = Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return (heads.withColumn("sd", so_far("docs")).withColumn("si", so_far("ids"))
            .join(F.broadcast(bases), F.col("range") == F.col("r"))
            .select("range", "number", "docs", "ids", (F.col("d") + F.col("sd")).alias("first_doc"),
                    (F.col("i") + F.col("si")).alias("first_id")))


def _documents(text: bool, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for s in segments(content.as_buffer()):
                    places = np.arange(s.docs)
                    starts, ends = s.starts(places), s.ends(places)
                    wide = s.ids.astype("<u4")
                    sums = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [pa.array(np.full(s.docs, s.range)), pa.array(np.full(s.docs, s.number)),
                               pa.array(places), pa.array(s.names(), pa.string() if text else pa.int64()),
                               pa.array(starts), pa.array(ends - starts), pa.array(sums, pa.int64())]
                    names = ["range", "number", "place", "id", "at", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(list_array(wide.astype(np.int32), ends - starts, pa.int32()))
                        names.append("token_ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
    return run


def read_ids(spark: SparkSession, path: str, id_type: T.DataType | None = None, with_ids: bool = False) -> DataFrame:
    """(id, doc_no, start, n_tokens, ids_crc32[, token_ids]) per document of the files at
    ``path``: its number and the place of its first id within the whole corpus."""
    id_type = id_type or T.LongType()
    text = isinstance(id_type, T.StringType)
    schema = (f"range long, number long, place long, id {'string' if text else 'long'}, at long, n_tokens long, "
              "ids_crc32 long" + (", token_ids array<int>" if with_ids else ""))
    docs = _files(spark, path).mapInArrow(_documents(text, with_ids), schema)
    catalog = spark.read.parquet(f"{path}/catalog").select(
        F.col("range").alias("cr"), F.col("number").alias("cn"), "first_doc", "first_id")
    side = F.broadcast(catalog) if catalog.count() <= CATALOG_BROADCAST else catalog
    out = docs.join(side, (F.col("range") == F.col("cr")) & (F.col("number") == F.col("cn")))
    return out.select(F.col("id").cast(id_type).alias("id"), (F.col("first_doc") + F.col("place")).alias("doc_no"),
                      (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      *(["token_ids"] if with_ids else []))


def write_and_read(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the documents' ids to new files below the shared folder and read them back."""
    path = scratch_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, id_col, **options)
    return read_ids(docs.sparkSession, path, docs.schema[id_col].dataType).withColumnRenamed("id", id_col)
