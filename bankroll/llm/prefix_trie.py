"""Prefix trie of conversations, kept as a z-fast trie.

Every conversation is a sequence of turns. The compacted trie has a node where sequences part or
end; the edge above it skips all turns on which its members agree. A node is stored under the
signature of its handle: the prefix whose length is the two-fattest number (that with the most
trailing zero bits) of the edge's depths. To find where a sequence leaves the trie, a fat binary
search probes the handles at the two-fattest depth of the interval that is left: each probe
is one equi-join for all sequences, and the logarithm of the longest sequence bounds their number.

Sequences are inserted in batches without conflicts. All that wait are located; of those that
leave the trie at one place with one next turn, the longest is inserted as a leaf, and every edge
is split at all the places found. The others wait, and will go further along the new edges, until
none is left. Totals of subtrees are summed by pointer doubling over the compacted nodes, and the
edges are then expanded to one row a depth.

Signatures are the exclusive or of 120 bits of each turn's digest and place, summed up along a
conversation by ranges (``operators.ordering``), so that a conversation with very many turns is not one
task. Very many sequences may probe one place of the trie. Prefixes and nodes consist of numbers
only, and there are at most two nodes a sequence, so their size is known from counts: within the
bounds of ``operators.joins`` they are broadcast, beyond them ``lookup_join`` splits hot keys.

Cases: rows without a conversation id belong to no conversation and are left out. A null role or text
is empty; a null turn comes first. Turns with one number go by the digest of role and text, so rows that
repeat are turns of their own. A very long text counts by its digest. An empty table gives no
rows. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join, max_broadcast_bytes, max_broadcast_rows
from ..operators.ordering import lay_out, running
from .common import written

HEAD_TURNS = 6               # a conversation begins with 0 to 5 turns of its group's first one
GROUP = 100
PROBES_A_PLAN = 8            # probes whose joins make one plan
CHUNK_BYTES = 1 << 16        # of conversation ids hashed as one row
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ conversations
def digest(role: Column, text: Column) -> Column:
    """One value for each (role, text)."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, k, digest, chars): the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                digest(role, text).alias("digest"), F.length(text).cast("long").alias("chars"))
    laid = lay_out(rows.filter("conv is not null"), ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest")])
    return written(running(laid, ["conv"], {"k": F.lit(1)}).select("conv", "k", "digest", "chars"), "trie-turns")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations (conv, size), turns (conv, d, digest, chars)): each conversation c begins with the
    first ``crc32(c) % 6`` turns of conversation ``c - c % 100`` and goes on with its own after as many."""
    sizes = own.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    heads = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEAD_TURNS)).cast("long")
    convs = sizes.select("conv", "own", (F.col("conv") - F.col("conv") % GROUP).alias("base"), heads.alias("h"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("own").alias("there")), "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = written(convs.select("conv", "base", "h", taken.alias("taken"), (
        taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")), "trie-conversations")
    # at most GROUP conversations share a base, of which at most HEAD_TURNS - 1 turns are taken
    first = own.filter(F.col("k") < HEAD_TURNS).withColumnRenamed("conv", "base")
    begin = convs.select("conv", "base", "taken").join(first, "base").filter("k <= taken").select(
        "conv", F.col("k").alias("d"), "digest", "chars")
    rest = lookup_join(own, convs.select("conv", "h", "taken"), "conv").filter("k > h").select(
        "conv", (F.col("k") - F.col("h") + F.col("taken")).alias("d"), "digest", "chars")
    return convs.select("conv", "size"), begin.unionByName(rest)


def prefixes(sequence: DataFrame) -> DataFrame:
    """(x, d, s1, s2, chars, cum): for each conversation and depth the signature of the prefix, the
    characters of its last turn, and of all of it."""
    both = F.md5(F.concat_ws(":", F.col("d").cast("string"), "digest").cast("binary"))
    part = lambda k: F.conv(F.substring(both, k, 15), 16, 10).cast("long")
    laid = lay_out(sequence.select(F.col("conv").alias("x"), "d", "chars", part(1).alias("e1"), part(16).alias("e2")),
                   ["x"], ["d"])
    return written(running(laid, ["x"], {"cum": F.col("chars")}, {"s1": F.col("e1"), "s2": F.col("e2")})
                   .select("x", "d", "s1", "s2", "chars", "cum"), "trie-prefixes")


# ------------------------------------------------------------------ z-fast trie
def two_fattest(low: Column, high: Column) -> Column:
    """The number with the most trailing zero bits among low+1..high."""
    top = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), top))


def look_up(rows: DataFrame, side: DataFrame, on: list[str], most: int, how: str = "left") -> DataFrame:
    """Join of ``rows`` to a ``side`` of numbers with unique keys and at most ``most`` rows."""
    fits = most <= max_broadcast_rows(rows) and 8 * len(side.columns) * most <= max_broadcast_bytes(rows)
    return rows.join(F.broadcast(side), on, how) if fits else lookup_join(rows, side, on, how)


class Prefixes:
    """Signatures of the prefixes of all sequences: rows (x, d, s1, s2, chars, cum)."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows, self.count = rows, rows.count()

    def of(self, rows: DataFrame, depth: Column, one: str, two: str, who: str = "x") -> DataFrame:
        """``rows`` with the signature (``one``, ``two``) of the prefix of sequence ``who`` at ``depth`` (null
        where it has none)."""
        side = self.rows.select(F.col("x").alias("__x"), F.col("d").alias("__d"), F.col("s1").alias(one),
                                F.col("s2").alias(two))
        keyed = rows.withColumns({"__x": F.col(who), "__d": depth.cast("long")})
        return look_up(keyed, side, ["__x", "__d"], self.count).drop("__x", "__d")


NODE = ["rep", "lo", "hi", "h1", "h2", "e1", "e2", "c1", "c2", "fat"]


def _with_signatures(nodes: DataFrame, prefix: Prefixes) -> DataFrame:
    """Nodes (rep, lo, hi) with their handle, its signature, and those of the extent and of the first
    turn below the parent."""
    out = nodes.select("rep", "lo", "hi", two_fattest(F.col("lo"), F.col("hi")).alias("fat"))
    out = prefix.of(out, F.col("fat"), "h1", "h2", "rep")
    out = prefix.of(out, F.col("hi"), "e1", "e2", "rep")
    return prefix.of(out, F.col("lo") + 1, "c1", "c2", "rep").select(*NODE)


def locate(waiting: DataFrame, nodes: DataFrame, prefix: Prefixes, longest: int, most: int) -> DataFrame:
    """(x, size, at, rep, lo, hi): where each sequence (x, size) leaves the trie: after ``at`` turns,
    inside of the edge (rep, lo, hi], or at a node (rep null). ``most``: bound on the nodes."""
    none = F.lit(None).cast("long")
    state = waiting.select("x", "size", F.lit(0).cast("long").alias("a"), F.col("size").alias("b"),
                           none.alias("rep"), none.alias("lo"), none.alias("hi"))
    handles = nodes.select(F.col("rep").alias("nr"), F.col("lo").alias("nl"), F.col("hi").alias("nh"),
                           F.col("fat").alias("__f"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), "e1", "e2")
    for k in range(max(1, longest.bit_length() + 1)):
        going = F.col("rep").isNull() & (F.col("a") < F.col("b"))
        probe = state.withColumn("__f", F.when(going, two_fattest(F.col("a"), F.col("b"))))
        probe = prefix.of(probe, F.col("__f"), "p1", "p2")
        probe = look_up(probe, handles, ["__f", "p1", "p2"], most)
        # the extent of the node that is found: all of it may agree, or the sequence leaves inside
        reach = F.when(F.col("nh") <= F.col("size"), F.col("nh"))
        probe = prefix.of(probe, reach, "x1", "x2")
        whole = (F.col("x1") == F.col("e1")) & (F.col("x2") == F.col("e2")) & reach.isNotNull()
        found, whole = F.col("nr").isNotNull(), F.coalesce(whole, F.lit(False))
        inside = found & ~whole
        state = probe.select(
            "x", "size", F.when(found & whole, F.col("nh")).otherwise(F.col("a")).alias("a"),
            F.when(going & ~found, F.col("__f") - 1).otherwise(F.col("b")).alias("b"),
            *[F.when(inside, F.col(n)).otherwise(F.col(o)).alias(o) for n, o in (("nr", "rep"), ("nl", "lo"), ("nh", "hi"))])
        if k % PROBES_A_PLAN == PROBES_A_PLAN - 1:
            state = written(state, "trie-probes")
    # below the deepest node that agrees: the edge that begins with the next turn, if there is one
    below = F.when(F.col("rep").isNull() & (F.col("a") < F.col("size")), F.col("a") + 1)
    child = prefix.of(state.withColumn("__f", below), F.col("__f"), "p1", "p2")
    edges = nodes.select(F.col("rep").alias("nr"), F.col("lo").alias("nl"), F.col("hi").alias("nh"),
                         (F.col("lo") + 1).alias("__f"), F.col("c1").alias("p1"), F.col("c2").alias("p2"))
    child = look_up(child, edges, ["__f", "p1", "p2"], most)
    out = written(child.select("x", "size", "a", F.coalesce("rep", "nr").alias("rep"), F.coalesce("lo", "nl").alias("lo"),
                               F.coalesce("hi", "nh").alias("hi")), "trie-located")
    # inside of an edge: the depths on which the sequence and the edge's own agree
    mine = prefix.rows.select("x", F.col("d").alias("__d"), F.col("s1").alias("x1"), F.col("s2").alias("x2"))
    along = out.filter("rep is not null").join(mine, "x").filter("__d > lo and __d <= hi")
    theirs = prefix.rows.select(F.col("x").alias("rep"), F.col("d").alias("__d"), F.col("s1").alias("p1"), F.col("s2").alias("p2"))
    agree = look_up(along, theirs, ["rep", "__d"], prefix.count, "inner").filter("x1 = p1 and x2 = p2").groupBy("x").agg(
        F.max("__d").alias("m"))
    return out.join(agree, "x", "left").select("x", "size", F.coalesce("m", "a").alias("at"), "rep", "lo", "hi")


def grow(sequences: DataFrame, count: int, prefix: Prefixes) -> DataFrame:
    """The nodes (``NODE``) of the compacted trie of ``count`` distinct ``sequences`` (x, size), but for the root."""
    spark = sequences.sparkSession
    longest = sequences.agg(F.max("size")).first()[0] or 0
    waiting = sequences.filter("size > 0").select("x", "size")
    nodes = spark.createDataFrame([], ", ".join(f"{c} long" for c in NODE))
    while waiting.limit(1).count():
        located = written(locate(waiting, nodes, prefix, longest, 2 * count), "trie-exits")
        left = prefix.of(located.filter("at < size"), F.col("at") + 1, "n1", "n2").withColumn("n", F.col("at") + 1)
        chosen = left.groupBy("n", "n1", "n2").agg(F.min_by(F.struct("x", "size", "at"), F.struct(-F.col("size"), "x")).alias("c"))
        leaves = written(chosen.select("c.*"), "trie-leaves")
        # an edge ends at each place where a sequence leaves it, and at its own end
        cuts = located.filter("rep is not null").select("rep", "lo", "hi", "at").distinct()
        split = cuts.groupBy("rep", "lo", "hi").agg(F.array_sort(F.collect_set("at")).alias("at"))
        depths = F.concat(F.array("lo"), F.col("at"), F.array("hi"))
        pieces = split.select("rep", F.explode(F.arrays_zip(
            F.slice(depths, 1, F.size("at") + 1).alias("lo"), F.slice(depths, 2, F.size("at") + 1).alias("hi"))).alias("p"))
        fresh = pieces.select("rep", "p.lo", "p.hi").unionByName(
            leaves.select(F.col("x").alias("rep"), F.col("at").alias("lo"), F.col("size").alias("hi")))
        old = nodes.join(split.select("rep", "hi"), ["rep", "hi"], "left_anti").select(*NODE)
        nodes = written(old.unionByName(_with_signatures(fresh, prefix)), "trie-nodes")
        waiting = written(left.select("x", "size").join(leaves.select("x"), "x", "left_anti"), "trie-waiting")
    return nodes


# ------------------------------------------------------------------ subtrees
def _totals(tree: DataFrame, values: dict, most: int) -> DataFrame:
    """(id, values): for each node of ``tree`` (id, parent, values; at most ``most`` rows) the totals of its subtree, by pointer
    doubling: after round k they reach over 2^k levels."""
    names = list(values)
    state = tree.select("id", F.col("parent").alias("up"), *names)
    while state.filter("up is not null").limit(1).count():
        more = state.filter("up is not null").groupBy(F.col("up").alias("id")).agg(
            *[values[n][0](n).alias(f"more_{n}") for n in names])
        ups = state.filter("up is not null").select(F.col("id").alias("up"), F.col("up").alias("next"))
        merged = state.join(more, "id", "left").select("id", "up", *[
            values[n][1](F.col(n), F.col(f"more_{n}")).alias(n) for n in names])
        moved = look_up(merged.filter("up is not null"), ups, ["up"], most).select(
            "id", F.col("next").alias("up"), *names)
        state = written(moved.unionByName(merged.filter("up is null")), "trie-totals")
    return state.select("id", *names)


_ADD = (F.sum, lambda a, b: a + F.coalesce(b, F.lit(0)))
_LEAST = (F.min, lambda a, b: F.least(a, b))  # least() passes over nulls


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, s1, s2, first, text): the ascending ids of each end, comma-joined, in chunks."""
    def row(key, first, ids):
        return (*key, first, ",".join(map(str, ids)))

    def out(rows):
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["size", "s1", "s2", "first", "text"])

    key, ids = None, []
    for batch in batches:
        rows = []
        for *now, conv in zip(*(batch.column(c).to_pylist() for c in ("size", "s1", "s2", "conv"))):
            if now != key or len(ids) >= CHUNK_BYTES // 8:
                if ids:
                    rows.append(row(key, ids[0], ids))
                key, ids = now, []
            ids.append(conv)
        yield out(rows)
    if ids:
        yield out([row(key, ids[0], ids)])


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, s1, s2, ends_sha256) of chunks in order; only the running hash is held."""
    def out(rows):
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["size", "s1", "s2", "ends_sha256"])

    key, state = None, None
    for batch in batches:
        rows = []
        for *now, text in zip(*(batch.column(c).to_pylist() for c in ("size", "s1", "s2", "text"))):
            if now == key:
                state.update(b",")
            else:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            state.update(text.encode("ascii"))
        yield out(rows)
    if key is not None:
        yield out([(*key, state.hexdigest())])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(size, s1, s2, ends_sha256) of ``ends`` (conv, size, s1, s2): SHA-256 of the ascending decimal ids
    that end there, comma-joined. Ids are joined to chunks by ranges, so the task that hashes an end with
    very many ids reads few rows, one at a time."""
    key = ["size", "s1", "s2"]
    ranged = ends.select(*key, "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    chunks = ranged.mapInArrow(_joined, "size long, s1 long, s2 long, first long, text string")
    return chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        _hashed, "size long, s1 long, s2 long, ends_sha256 string")


# ------------------------------------------------------------------ the trie
def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): every node
    of the trie of the rebuilt conversations, one row a depth."""
    convs, sequence = rebuilt(turns(conversations, conv_col, turn_col, role_col, text_col))
    every = prefixes(sequence)
    last = every.select(F.col("x").alias("conv"), F.col("d").alias("size"), "s1", "s2")
    ends = written(convs.join(last, ["conv", "size"], "left").na.fill(0, ["s1", "s2"]), "trie-ends")
    sequences = written(ends.groupBy("size", "s1", "s2").agg(F.min("conv").alias("x"), F.count(F.lit(1)).alias("n")),
                        "trie-sequences")
    count = sequences.count()
    most = 2 * count + 1
    prefix = Prefixes(written(look_up(every, sequences.select("x"), ["x"], count, "inner"), "trie-distinct"))
    distinct = prefix.rows
    nodes = grow(sequences, count, prefix)

    # compacted nodes with their parents and their own ends; the root has the number 0
    top = distinct.sparkSession.range(1).filter(F.lit(count > 0))
    root = top.select(F.lit(0).cast("long").alias("id"), *[F.lit(None).cast("long").alias(c) for c in ("rep", "lo")],
                      *[F.lit(0).cast("long").alias(c) for c in ("hi", "e1", "e2", "p1", "p2", "before", "whole")])
    tree = nodes.select((F.monotonically_increasing_id() + 1).alias("id"), "rep", "lo", "hi", "e1", "e2")
    cum = lambda at: distinct.select(F.col("x").alias("rep"), F.col("d").alias(at), F.col("cum").alias(
        "before" if at == "lo" else "whole"), *([F.col("s1").alias("p1"), F.col("s2").alias("p2")] if at == "lo" else []))
    tree = tree.join(cum("lo"), ["rep", "lo"], "left").join(cum("hi"), ["rep", "hi"]).na.fill(0, ["p1", "p2", "before"])
    tree = written(tree.select(*root.columns).unionByName(root), "trie-tree")
    parents = tree.select(F.col("id").alias("parent"), F.col("hi").alias("lo"), F.col("e1").alias("p1"), F.col("e2").alias("p2"))
    tree = look_up(tree, parents, ["lo", "p1", "p2"], most)
    own = sequences.select(F.col("size").alias("hi"), F.col("s1").alias("e1"), F.col("s2").alias("e2"),
                           F.col("n").alias("n_ends"), F.col("x").alias("least"))
    tree = tree.join(own, ["hi", "e1", "e2"], "left").na.fill(0, ["n_ends"])
    children = tree.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = written(tree.join(children, "id", "left").na.fill(0, ["n_children"]).withColumn(
        "leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "trie-tree")

    sums = written(_totals(tree.select("id", "parent", F.col("n_ends").alias("n_convs"), F.col("least").alias("conv_id"),
                                       F.col("leaf").alias("n_leaves")),
                           {"n_convs": _ADD, "conv_id": _LEAST, "n_leaves": _ADD}, most), "trie-sums")
    tree = written(tree.drop("least", "leaf").join(sums, "id").withColumn(
        "edge", (F.col("n_convs") - 1) * (F.col("whole") - F.col("before"))), "trie-tree")
    saved = _totals(tree.select("id", "parent", F.col("edge").alias("all")), {"all": _ADD}, most)
    above = tree.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    tree = look_up(tree.join(saved, "id"), above, ["parent"], most)
    hashes = end_hashes(ends).select(F.col("size").alias("hi"), F.col("s1").alias("e1"), F.col("s2").alias("e2"), "ends_sha256")
    tree = written(tree.join(hashes, ["hi", "e1", "e2"], "left"), "trie-tree")

    # one row a depth of each edge
    down = tree.withColumn("d", F.explode(F.sequence(F.coalesce(F.col("lo") + 1, F.lit(0)), F.col("hi"))))
    down = down.join(distinct.select(F.col("x").alias("rep"), "d", "chars", "cum"), ["rep", "d"], "left")
    last, first = F.col("d") == F.col("hi"), F.col("d") == F.col("lo") + 1
    below = F.col("all") - F.col("edge")
    rest = (F.col("n_convs") - 1) * (F.col("whole") - F.col("cum") + F.col("chars"))
    return down.select(
        "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") == 0, F.lit(None)).when(first, F.col("above")).otherwise(F.col("conv_id")).cast("long").alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (below + F.coalesce(rest, F.lit(0))).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))
