"""Phrase collocations over a weighted de Bruijn graph.

Per language, the nodes are sequences of three words that overlap by two; an edge is a
sequence of four words, weighted by its occurrences within pieces (text between punctuation
marks). Only the edges are counted from the texts, together with the two and three words
that end a piece, where no edge can begin. All shorter counts follow by adding up:

* a node's flow is the weight of the edges that leave it, plus the pieces that end in it;
* a pair's count is the flow of the nodes that begin with it, plus the pieces that end in it.

A node through which everything goes from one edge to one other (three equal weights)
is unary. ``compact`` joins the edges over such nodes to paths by pointer doubling; paths
and the nodes between them are the graph that is kept. Of a path, edges and inner nodes have its
weight.

Words are counted first. Those below the threshold can be in no phrase that reaches it, and
break pieces like punctuation does; the others are numbered, so that an edge is two 64-bit
numbers. If there are too many words to send to every task, hashes stand for the numbers and nothing is
left out: the results are the same. Pairs of two very common words are dealt by their third
word too, so no task gets all edges of one pair.

Rules: A-Z are lower-cased; pieces are split at ``. , ; : ! ?`` and U+000A to U+000D, words are runs of
other characters than space and tab. Words are told apart by 64-bit hashes in a worker's batch;
two words of the vocabulary with one hash raise an error.

Cases: a null text is empty; a null language is ``und``. Repeated rows count as often as they come.
A long text is read in slices. An empty table gives no phrases. Extra columns are not looked at.
Equal scores go by the count, then by the phrase in the order of its UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from . import textnp
from .common import ranges, string_buffers, text_batches, written

LEAST = 30               # occurrences of a candidate
TOP = 2000               # phrases of a language
LONGEST = 4              # words of a phrase
UNKNOWN_LANG = "und"
VOCABULARY = 4_000_000   # numbered words (8 bytes each in every task); beyond it hashes stand for numbers
HOT_SHARE = 1 / 256      # of all words: pairs of two such words are dealt by their third word too
SALTS = 64
BATCH = 8 << 20          # text whose edges are counted at once
SLICE = 2 << 20          # text cut into words at once
PATH_EDGES = 1024        # edges of one row of a path
RANK_ROWS = 100_000      # candidates ranked by one task
CODES = ["a", "b", "c", "d"]
_HALF = (1 << 32) - 1
_KIND = np.zeros(256, np.uint8)  # 1: between words, 2: between pieces
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = 2


def _tokens(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, end, text, new piece) of the words of all texts, slice by slice."""
    last, low = (-1, -1), 0
    broken = 0
    while low < len(data):
        high = min(len(data), low + SLICE)
        if high < len(data):  # a slice ends before a separator
            seek = np.flatnonzero(_KIND[data[high:high + SLICE]])
            while not len(seek) and high < len(data):  # a very long word
                high = min(len(data), high + SLICE)
                seek = np.flatnonzero(_KIND[data[high:high + SLICE]])
            high += int(seek[0]) if len(seek) else 0
        kind = _KIND[data[low:high]]
        inside = np.zeros(high - low + 2, np.int8)
        inside[1:-1] = kind == 0
        change = np.diff(inside)
        start, end = np.flatnonzero(change == 1) + low, np.flatnonzero(change == -1) + low
        cut = offsets[(offsets > low) & (offsets < high)]  # no word runs over the border of two texts
        cut = np.unique(cut)
        cut = cut[(inside[cut - low] == 1) & (inside[cut - low + 1] == 1)]
        if len(cut):
            start, end = np.sort(np.r_[start, cut]), np.sort(np.r_[end, cut])
        breaks = np.cumsum(kind == 2) + broken
        broken = int(breaks[-1])
        text = np.searchsorted(offsets, start, side="right") - 1
        piece = breaks[start - low]
        new = (np.diff(piece, prepend=last[0]) != 0) | (np.diff(text, prepend=last[1]) != 0)
        if len(start):
            last = (int(piece[-1]), int(text[-1]))
            yield start, end, text, new
        low = high


def _lang_keys(langs: list) -> tuple[np.ndarray, list[str]]:
    """(number of each row's language, the languages)."""
    names = sorted({UNKNOWN_LANG if x is None else x for x in langs})
    number = {x: k for k, x in enumerate(names)}
    return np.array([number[UNKNOWN_LANG if x is None else x] for x in langs], np.int64), names


def _salt(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode("utf-8"), digest_size=8).digest(), "<u8")[0]


def _keyed(batch: pa.RecordBatch):
    """The batch's bytes, and per slice of its words (start, end, language, key, new piece)."""
    data, offsets = string_buffers(batch.column("text"))
    row_lang, names = _lang_keys(batch.column("lang").to_pylist())
    salts = np.array([_salt(x) for x in names], np.uint64)

    def slices():
        for start, end, text, new in _tokens(data, offsets):
            low = start[0]
            h = textnp.hash_words(data[low:end[-1]], start - low, end - low)
            lang = row_lang[text]
            yield start, end, lang, textnp.mix(h ^ salts[lang]), new
    return data, names, slices()


# ------------------------------------------------------------------ words
def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n): the words of each slice and their counts."""
    for batch in text_batches(batches, "text", BATCH):
        data, names, slices = _keyed(batch)
        for start, end, lang, key, _ in slices:
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            size = end[first] - start[first]
            raw = textnp._LOWER[data[ranges(start[first], size)]]
            offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
            words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(raw))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names).take(pa.array(lang[first])), words, pa.array(n)], ["lang", "word", "n"])


def _codes(keys: np.ndarray | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column("word"))
            row_lang, names = _lang_keys(batch.column("lang").to_pylist())
            key = textnp.hash_words(data, offsets[:-1], offsets[1:])
            key = textnp.mix(key ^ np.array([_salt(x) for x in names], np.uint64)[row_lang])
            yield pa.RecordBatch.from_arrays([pa.array(_number(key, keys)), batch.column("lang"), batch.column("word"),
                                              batch.column("n")], ["code", "lang", "word", "n"])
    return run


def _number(key: np.ndarray, keys: np.ndarray | None) -> np.ndarray:
    """The code of each key: its place among the sorted ``keys`` from 1 on, 0 if it is none of
    them; without ``keys`` the key itself."""
    if keys is None:
        return key.view(np.int64)
    if not len(keys):
        return np.zeros(len(key), np.int64)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, at + 1, 0)


# ------------------------------------------------------------------ edges
def _edges(keys: np.ndarray | None, hot: np.ndarray):
    """(x, y, salt, n), or (a, b, c, d, salt, n) without ``keys``: the edges of each batch, and
    the pairs and triples that end a piece (0 for the words they lack)."""
    names = (["x", "y"] if keys is not None else CODES) + ["salt", "n"]

    def rows(code: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        """``stop``: words of the piece from each word on, at most four."""
        k = np.flatnonzero(stop >= 2)
        four = [code[np.minimum(k + j, len(code) - 1)] * (stop[k] > j) for j in range(4)]
        both = np.isin(four[0], hot) & np.isin(four[1], hot)
        salt = np.where(both, 1 + (textnp.mix(four[2].view(np.uint64)) % np.uint64(SALTS)).astype(np.int64), 0)
        columns = [(four[0] << 32) | four[1], (four[2] << 32) | four[3]] if keys is not None else four
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.ones(len(k), bool)
        if len(k):
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(k)])
        columns = [c[first] for c in columns] + [salt[order][first].astype(np.int32), n.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH):
            _, _, slices = _keyed(batch)
            code, new = np.zeros(0, np.int64), np.zeros(0, bool)
            for _, _, _, key, begins in slices:
                code, new = np.r_[code, _number(key, keys)], np.r_[new, begins]
                # the last three words wait for those that follow them
                done = max(0, len(code) - (LONGEST - 1))
                yield rows(*_ahead(code, new, done, keys is not None))
                code, new = code[done:], new[done:]
            yield rows(*_ahead(code, new, len(code), keys is not None))
    return run


def _ahead(code: np.ndarray, new: np.ndarray, done: int, rare: bool) -> tuple[np.ndarray, np.ndarray]:
    """(code, stop) with ``stop`` 0 from place ``done`` on and for words that are left out."""
    size = len(code)
    stop = np.zeros(size, np.int64)
    alive = np.arange(size) < done
    for j in range(LONGEST):
        at = np.arange(size) + j
        there = at < size
        at = np.minimum(at, size - 1)
        alive = alive & there
        if rare:
            alive &= code[at] != 0
        if j:
            alive &= ~new[at]
        stop += alive
    return code, stop


# ------------------------------------------------------------------ the graph
class Graph:
    """Counts of all sequences of one to four words that reach the threshold: ``paths`` (path,
    block, a, b, c, next, f), ``nodes`` between them, ``pairs``, the ``words`` with their
    codes, and ``totals`` (lang, n)."""

    def __init__(self, paths: DataFrame, nodes: DataFrame, pairs: DataFrame, words: DataFrame, totals: DataFrame) -> None:
        self.paths, self.nodes, self.pairs, self.words, self.totals = paths, nodes, pairs, words, totals

    def _along(self, size: int) -> DataFrame:
        """The sequences of ``size`` words along the paths: all edges (4), or the inner nodes (3)."""
        words = F.concat(F.array("a", "b", "c"), F.col("next"))
        first, count = (0, F.size("next")) if size == 4 else (1, F.size("next") - F.when(F.col("last"), 1).otherwise(0))
        places = F.sequence(F.lit(1), count)
        at = self.paths.filter(count >= 1).select("f", words.alias("w"), F.explode(places).alias("k"))
        return at.select(*[F.element_at("w", F.col("k") + first + j).alias(CODES[j]) for j in range(size)], "f")

    def counts(self) -> DataFrame:
        """(a, b, c, d, f): every sequence of one to four words, 0 for the words it lacks."""
        parts = [self._along(4), self._along(3), self.nodes, self.pairs,
                 self.words.select(F.col("code").alias("a"), F.col("n").alias("f"))]
        return reduce(lambda x, y: x.unionByName(y), [
            p.select(*[F.col(c) if c in p.columns else F.lit(0).cast("long").alias(c) for c in CODES], "f")
            for p in parts])


def _flows(docs: DataFrame, keys: np.ndarray | None, hot: np.ndarray,
           least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (a, b, c, d, f), nodes and pairs of ``least`` occurrences or more. All of a pair's
    edges meet in one task (those of a very common pair by their third word), so that each sum
    uses the same exchange."""
    code = "x long, y long" if keys is not None else "a long, b long, c long, d long"
    dealt = docs.mapInArrow(_edges(keys, hot), f"{code}, salt int, n long")
    if keys is not None:
        dealt = dealt.repartition("x", "salt")
        first, third, last = ["x"], F.shiftright("y", 32), [F.col("y")]
        back = {"a": F.shiftright("x", 32), "b": F.col("x").bitwiseAND(_HALF)}
        back |= {"c": F.shiftright("y", 32), "d": F.col("y").bitwiseAND(_HALF)}
    else:
        dealt = dealt.repartition("a", "b", "salt")
        first, third, last = ["a", "b"], F.col("c"), [F.col("c"), F.col("d")]
        back = {c: F.col(c) for c in CODES}
    # every sum reads every column and filters by its sum only: else the columns and rows that one
    # of them does not need would be taken out before the exchange, which they then could not share
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in dealt.columns])
    total, enough, zero = F.sum(F.when(whole, F.col("n"))).alias("f"), F.col("f") >= least, F.lit(0).cast("long")
    edges = dealt.groupBy(*first, "salt", *last).agg(total).filter(enough).select(
        F.lit(4).alias("size"), *[back[c].alias(c) for c in CODES], "f")
    nodes = dealt.groupBy(*first, "salt", third.alias("c")).agg(total).filter(enough).select(
        F.lit(3).alias("size"), back["a"].alias("a"), back["b"].alias("b"), "c", zero.alias("d"), "f")
    pairs = dealt.groupBy(*first, "salt").agg(total).filter(
        F.col("f") >= F.when(F.col("salt") == 0, least).otherwise(1)).select(
        F.lit(2).alias("size"), back["a"].alias("a"), back["b"].alias("b"), zero.alias("c"), zero.alias("d"), "f")
    found = written(edges.unionByName(nodes).unionByName(pairs), "phrases-flows")
    pairs = found.filter("size = 2").groupBy("a", "b").agg(F.sum("f").alias("f")).filter(enough)
    return found.filter("size = 4 and d <> 0"), found.filter("size = 3 and c <> 0"), pairs


def compact(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, nodes between them) of the graph of ``edges`` (a, b, c, d, f) and ``nodes`` (a, b, c, f).

    A node with one edge in and one out of its own weight is unary. Each edge points to the
    one before it over a unary node; pointers double until all reach the head of their path.
    A path cannot be a ring: what goes round would have to begin and to end somewhere.
    """
    edges = written(edges.select(*CODES, "f").withColumn("e", F.monotonically_increasing_id()), "phrases-edges")
    node = nodes.select(F.col("a").alias("p"), F.col("b").alias("q"), F.col("c").alias("r"), F.col("f").alias("g"))
    before = edges.select(F.col("e").alias("before"), F.col("b").alias("p"), F.col("c").alias("q"),
                          F.col("d").alias("r"), F.col("f").alias("g"))
    unary = before.join(node, ["p", "q", "r", "g"])  # all that is in the node comes over one edge
    after = edges.join(unary, (F.col("a") == F.col("p")) & (F.col("b") == F.col("q")) & (F.col("c") == F.col("r"))
                       & (F.col("f") == F.col("g")), "left")
    at = written(after.select("e", *CODES, "f", F.coalesce("before", "e").alias("head"),
                              F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("rank"),
                              F.col("before").isNotNull().alias("open")), "phrases-paths")
    while at.filter("open").limit(1).count():
        # open rows point to different edges, so this join has no hot key
        to = at.select(F.col("e").alias("te"), F.col("head").alias("th"), F.col("rank").alias("tr"), F.col("open").alias("to"))
        moved = at.filter("open").join(to, F.col("head") == F.col("te")).select(
            "e", *CODES, "f", F.col("th").alias("head"), (F.col("rank") + F.col("tr")).alias("rank"), F.col("to").alias("open"))
        at = written(at.filter("not open").unionByName(moved), "phrases-paths")
    block = F.floor(F.col("rank") / PATH_EDGES).cast("long")
    rows = at.groupBy(F.col("head").alias("path"), block.alias("block")).agg(
        F.max("f").alias("f"), F.sort_array(F.collect_list(F.struct("rank", *CODES))).alias("x"))
    length = Window.partitionBy("path")
    paths = rows.select("path", "block", "x.a", "x.b", "x.c", "x.d", "f", (
        F.col("block") == F.max("block").over(length)).alias("last"))
    paths = paths.select("path", "block", "last", *[F.element_at(c, 1).alias(c) for c in "abc"],
                         F.col("d").alias("next"), "f")
    inner = unary.select(F.col("p").alias("a"), F.col("q").alias("b"), F.col("r").alias("c")).join(
        edges.select("a", "b", "c", F.col("f").alias("g")), ["a", "b", "c"]).select("a", "b", "c", "g")
    kept = nodes.select("a", "b", "c", "f").join(
        inner.withColumnRenamed("g", "f"), ["a", "b", "c", "f"], "left_anti")
    return written(paths, "phrases-compact"), written(kept, "phrases-nodes")


def build(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> Graph:
    """The compacted graph of all sequences that occur ``least`` times or more."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col), F.lit(UNKNOWN_LANG)).alias("lang"))
    every = written(docs.mapInArrow(_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "phrases-words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = every.filter(F.col("n") >= least)
    schema = "code long, lang string, word string, n long"
    hashed = written(frequent.mapInArrow(_codes(None), schema), "phrases-vocabulary")
    size, distinct = hashed.agg(F.count(F.lit(1)), F.count_distinct("code")).first()
    if size != distinct:
        raise ValueError("two words have one hash")
    keys = None
    words = hashed
    if size <= VOCABULARY:
        keys = np.sort(hashed.select("code").toArrow().column(0).to_numpy().view(np.uint64))
        words = written(frequent.mapInArrow(_codes(keys), schema), "phrases-vocabulary")
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    # at most 1 / HOT_SHARE words pass
    hot = np.array([r[0] for r in words.filter(F.col("n") > HOT_SHARE * all_words).select("code").collect()], np.int64)
    edges, nodes, pairs = _flows(docs, keys, hot, least)
    paths, nodes = compact(edges, nodes)
    return Graph(paths, nodes, pairs, words, totals)


# ------------------------------------------------------------------ collocations
def _length() -> Column:
    return sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in CODES), F.lit(0))


def _parts(first: int, last: int) -> list[Column]:
    """The words first..last-1 of a phrase as a sequence's codes."""
    zero = F.lit(0).cast("long")
    return [F.col(CODES[first + j]) if first + j < last else zero for j in range(LONGEST)]


def score(graph: Graph, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``top`` best phrases."""
    counts = written(graph.counts(), "phrases-counts")
    candidates = counts.withColumn("size", _length()).filter("size >= 2")
    # each cut of each candidate, with the counts of both parts
    cuts = [F.struct(F.lit(k).alias("k"), *[x.alias(f"l{c}") for c, x in zip(CODES, _parts(0, k))],
                     *[x.alias(f"r{c}") for c, x in zip(CODES, _parts(k, LONGEST))]) for k in range(1, LONGEST)]
    cut = candidates.select(*CODES, "f", "size", F.explode(F.slice(F.array(*cuts), F.lit(1), F.col("size") - 1)).alias("x"))
    cut = cut.select(*CODES, "f", "x.*")
    for side in "lr":
        names = [f"{side}{c}" for c in CODES]
        cut = lookup_join(cut, counts.toDF(*names, side), names)
    exact = F.expr("cast(2000000 as decimal(7,0)) * cast(f as decimal(19,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = cut.withColumn("score", exact.cast("long")).groupBy(*CODES, "f").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("m")).select(*CODES, "f", "m.score", "m.l", "m.r")
    # the phrases inside of longer ones, with the most that a longer one occurs
    inside = [F.struct(F.lit(n).alias("of"), *[x.alias(f"s{c}") for c, x in zip(CODES, _parts(i, j))])
              for n in (3, 4) for i in range(n) for j in range(i + 2, n + 1) if j - i < n]
    held = candidates.filter("size >= 3").select("f", "size", F.explode(F.array(*inside)).alias("s")).filter(
        "s.of = size").groupBy(*[F.col(f"s.s{c}").alias(c) for c in CODES]).agg(F.max("f").alias("longer"))
    kept = least.join(held, CODES, "left").filter("longer is null or 100 * cast(longer as decimal(20,0)) < 80 * cast(f as decimal(20,0))")
    words = graph.words.select("code", "lang", "word")
    kept = written(lookup_join(kept.drop("longer").withColumn("code", F.col("a")), words.select("code", "lang"), "code"),
                   "phrases-kept")
    # candidates beyond the best of their share are not spelt
    shares = max(1, -(-kept.count() // RANK_ROWS))
    best = [F.col("score").desc(), F.col("f").desc()]
    share = F.pmod(F.xxhash64(*CODES), F.lit(shares))
    some = kept.withColumn("share", share).withColumn("p", F.rank().over(Window.partitionBy("lang", "share").orderBy(*best)))
    some = some.filter(F.col("p") <= top).withColumn("p", F.rank().over(Window.partitionBy("lang").orderBy(*best)))
    some = some.filter(F.col("p") <= top).drop("share", "p", "code")
    for c in CODES:
        some = lookup_join(some.withColumn("code", F.col(c)), words.select("code", F.col("word").alias(f"w{c}")), "code",
                           how="left").drop("code")
    phrase = F.concat_ws(" ", *[f"w{c}" for c in CODES])
    ranked = some.withColumn("phrase", phrase).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase")).cast("long"))
    return (lookup_join(ranked.filter(F.col("rank") <= top), graph.totals, "lang")
            .select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """The ``top`` collocations of each language."""
    return score(build(docs, text_col, lang_col, least), top)
