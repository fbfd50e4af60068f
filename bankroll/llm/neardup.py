"""Near-duplicate documents by MinHash with tensored banding.

Plain banding with L tables of K minhashes computes L*K of them. Here two collections of
``m`` elements hold K/2 minhashes each, and the table (i, j) is keyed by element i of the
left collection and element j of the right one: m*m tables from 2*m*(K/2) minhashes. Two
documents meet in a table exactly if they share a left element and a right element, so
rows are dealt by left element only (m rows a document) and a group finds the right
elements that its members share.

Two texts of similarity s miss all tables with a probability below 2*(1 - s^(K/2))^m:
with m = 14, K = 4 at s = 0.75 this is 2e-5, and 1e-7 at 0.85. Candidates pass a size bound (exact) and
a count of equal minhashes (a link at s = 0.75 fails it with a probability of about
5e-4, at 0.8 of 1e-5); every link is confirmed on the full shingle sets.

Pairs of different components (below) also pass a sketch made in one permutation: of each
256th part of the hash range the least member. The share of equal ones among the parts that
either set occupies estimates the similarity; a pair fails four standard deviations (of
draws without replacement from the union) below 0.75, which a link does with a probability
below 4e-5. It keeps families that share much text, but less than 0.75, from being listed
pair by pair.

Documents with equal shingle sets are one class from the start. Links are sought in
rounds: each table's members against its least one; then, ``PARTNER_ROUNDS`` times, each
member against the one most like it by sketch of those in other components; then every pair
of a table whose members are still in different components. So the pairs inside a large group of
copies are never listed, and none between different components is left out.

Cases: a null or empty text, or one without words, has no shingles and links with nothing.
Fewer than five words make one shingle. Repeated rows are copies of each other; rows with
a null id take part, and a component's id is the least non-null id in it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp
from .common import list_array, ranges, string_buffers, text_batches, written
from .components import connected_components

ELEMENTS = 14            # m: elements of a collection
HASHES = 2               # K/2: minhashes of an element
SIGNATURE = 2 * ELEMENTS * HASHES
LEAST_EQUAL = 31         # of the 56 minhashes; expected 42 at a similarity of 0.75
GROUP_ROWS = 4096        # a larger group of one left element is handled in blocks
CELL_ROWS = 50_000       # rows of left groups in one task
PARTNER_ROUNDS = 2
CELL_SHINGLES = 2 << 20   # shingles of one verifying task
BINS = 256               # of the one-permutation sketch
_rng = np.random.default_rng(20240)
_XOR = _rng.integers(0, 1 << 64, SIGNATURE, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 64, SIGNATURE, dtype=np.uint64) | np.uint64(1)


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = string_buffers(batch.column("text"))
    start, end, first = textnp.words(data, offsets)
    return textnp.distinct(*textnp.shingles(textnp.hash_words(data, start, end), first))


def _set_keys(hashes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name each set; 0 for empty ones."""
    out = []
    for salt in (11, 13):
        total = np.r_[np.uint64(0), np.cumsum(textnp.mix(hashes ^ np.uint64(salt)))]
        out.append((total[own[1:]] - total[own[:-1]]).astype(np.int64))
    return out[0], out[1]


def signatures(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Minhashes [set, function] of sets that all have members."""
    out = np.empty((len(own) - 1, SIGNATURE), np.uint64)
    for k in range(SIGNATURE):
        out[:, k] = np.minimum.reduceat((hashes ^ _XOR[k]) * _MUL[k], own[:-1])
    return out


def _sketches(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A byte of the least hash in each part of the hash range [set, BINS]; 0: none there.
    The hashes of a set are sorted, so the first one of a part is its least."""
    part = (hashes >> np.uint64(56)).astype(np.int64)
    owner = np.repeat(np.arange(len(own) - 1), np.diff(own))
    least = np.ones(len(hashes), bool)
    least[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros((len(own) - 1, BINS), np.uint8)
    out[owner[least], part[least]] = hashes[least] % np.uint64(255) + np.uint64(1)
    return out


def _alike(sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a link is possible, estimated similarity) of pairs of sets of n members."""
    x, y = sketch[a], sketch[b]
    both = ((x == y) & (x > 0)).sum(1)
    either = np.maximum(((x | y) > 0).sum(1), 1)
    union = np.maximum((n[a] + n[b]) / 1.75, 1)  # of a link; smaller for more similar ones
    left = np.clip(1 - (either - 1) / union, 0.1, 1)
    return both >= 0.75 * either - 4 * np.sqrt(0.1875 * either * left) - 0.5, both / either


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text"):
        hashes, own = _sets(batch)
        n = np.diff(own)
        k1, k2 = _set_keys(hashes, own)
        full = np.flatnonzero(n > 0)
        tags = np.zeros((len(n), SIGNATURE), np.uint16)
        left = np.zeros((len(n), ELEMENTS), np.int64)
        if len(full):
            sig = signatures(hashes, np.r_[own[full], own[-1]])
            mixed = textnp.mix(sig)
            tags[full] = mixed.astype(np.uint16)
            key = np.zeros((len(full), ELEMENTS), np.uint64)
            for h in range(HASHES):
                key = textnp.mix(key + sig[:, h:ELEMENTS * HASHES:HASHES])
            left[full] = key.view(np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1), pa.array(k2),
            list_array(left[n > 0].ravel(), np.where(n > 0, ELEMENTS, 0), pa.int64()),
            pa.array([t.tobytes() if c else None for t, c in zip(tags, n)], pa.binary()),
            pa.array([t.tobytes() if c else None for t, c in zip(_sketches(hashes, own), n)], pa.binary()),
            batch.column("text_key"),
        ], ["doc_id", "n_shingles", "k1", "k2", "left", "tags", "sketch", "text_key"])


def _members(tbl: pa.Table, keys: list[str]) -> tuple:
    """(rep, shingles, tags, group number, columns) of one cell, sorted by group and rep."""
    pdf = tbl.to_pandas().sort_values([*keys, "rep"], ignore_index=True)
    tags = np.frombuffer(b"".join(pdf["tags"]), np.uint16).reshape(len(pdf), SIGNATURE)
    new = np.zeros(len(pdf), bool)
    for k in keys:
        new[1:] |= pdf[k].to_numpy()[1:] != pdf[k].to_numpy()[:-1]
    return pdf["rep"].to_numpy(), pdf["n_shingles"].to_numpy(), tags, np.cumsum(new), pdf


def _close(n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n[a], n[b]) >= 75 * np.maximum(n[a], n[b])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _star_pairs(tbl: pa.Table) -> pa.Table:
    """Of the groups of one cell: in each table, the pairs of its least member with the
    others, each pair once."""
    rep, n, tags, group, _ = _members(tbl, ["i", "key", "block"])
    rights = np.ascontiguousarray(tags[:, ELEMENTS * HASHES:]).view(np.uint32)
    found = []
    for j in range(ELEMENTS):
        order = np.lexsort((rights[:, j], group))
        r, g = rights[order, j], group[order]
        new = np.r_[True, (r[1:] != r[:-1]) | (g[1:] != g[:-1])]
        a, b = order[np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))], order
        a, b = a[~new], b[~new]
        keep = _close(n, a, b)
        a, b = a[keep], b[keep]
        keep = (tags[a] == tags[b]).sum(1) >= LEAST_EQUAL
        found.append(np.stack([rep[a[keep]], rep[b[keep]]], 1))
    found = np.unique(np.concatenate(found), axis=0)
    return _pairs(found[:, 0], found[:, 1])


PAIRS_AT_ONCE = 100_000


def _in_groups(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (a before b) of each group, some at a time."""
    size = np.bincount(group)
    stop = np.cumsum(size)[group]
    left = stop - np.arange(len(group)) - 1
    ends = np.cumsum(left)
    at = 0
    while at < len(group):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, side="right")))
        rows = np.arange(at, to)
        yield np.repeat(rows, left[at:to]), ranges(rows + 1, left[at:to])
        at = to


def _pairs_between(tbl: pa.Table, partners: bool) -> pa.Table:
    """Of the groups of one cell (of a large group: two of its blocks): the pairs of
    different components that share a right element, each pair only in the first group in
    which both meet. ``partners``: of these only each member's most similar one."""
    rep, n, tags, group, pdf = _members(tbl, ["i", "key", "x", "y"])
    comp, block, table = (pdf[c].to_numpy() for c in ("component", "block", "i"))
    apart = (pdf["x"] != pdf["y"]).to_numpy()
    sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), BINS)
    out = [np.zeros((0, 2), np.int64)]
    best = np.full(len(rep), -1.0)
    with_whom = np.full(len(rep), -1)
    for a, b in _in_groups(group):
        keep = (comp[a] != comp[b]) & _close(n, a, b) & ~(apart[a] & (block[a] == block[b]))
        a, b = a[keep], b[keep]
        same = tags[a] == tags[b]
        elements = same.reshape(len(a), 2, ELEMENTS, HASHES).all(3)
        first = elements[:, 0].argmax(1) == table[a]
        keep = first & elements[:, 1].any(1) & (same.sum(1) >= LEAST_EQUAL)
        a, b = a[keep], b[keep]
        keep, share = _alike(sketch, n, a, b)
        a, b, share = a[keep], b[keep], share[keep]
        if not partners:
            out.append(np.stack([rep[a], rep[b]], 1))
            continue
        for x, y in ((a, b), (b, a)):  # the last of ascending shares is written last
            by = np.argsort(share, kind="stable")
            x, y, s = x[by], y[by], share[by]
            better = s > best[x]
            best[x[better]], with_whom[x[better]] = s[better], y[better]
    if partners:
        has = np.flatnonzero(with_whom >= 0)
        pair = np.sort(np.stack([rep[has], rep[with_whom[has]]], 1), axis=1)
        out.append(np.unique(pair, axis=0))
    out = np.concatenate(out)
    return _pairs(out[:, 0], out[:, 1])


def _cross_pairs(tbl: pa.Table) -> pa.Table:
    return _pairs_between(tbl, False)


def _partner_pairs(tbl: pa.Table) -> pa.Table:
    return _pairs_between(tbl, True)


def _rehashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text"):
        hashes, own = _sets(batch)
        k1, k2 = _set_keys(hashes, own)
        n = np.diff(own)
        raw, ends = hashes.tobytes(), (own * 8).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(n, pa.int64()), pa.array(k1), pa.array(k2),
            pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        ], ["n_shingles", "k1", "k2", "members"])


def _confirmed(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """The pairs of one cell that pass 100 * intersection >= 75 * union."""
    a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    where = {r: k for k, r in enumerate(sets["rep"].to_pylist())}
    column = sets["members"].combine_chunks()
    full = [np.frombuffer(column[k].as_buffer(), np.uint64) for k in range(len(column))]
    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        p, q = full[where[x]], full[where[y]]
        if len(p) > len(q):
            p, q = q, p
        at = np.searchsorted(q, p)
        both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
        keep[k] = 100 * both >= 75 * (len(p) + len(q) - both)
    return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})


def _verify(pairs: DataFrame, sets: DataFrame, sides: int) -> DataFrame:
    """Confirmed pairs. Sets are dealt into ``sides`` parts; a task holds the pairs between
    two parts and the sets that these pairs name."""
    part = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(sides))
    cell = F.least(part("a"), part("b")) * sides + F.greatest(part("a"), part("b"))
    pairs = written(pairs.select(cell.cast("long").alias("cell"), "a", "b"), "neardup-pairs")
    named = (pairs.select(F.col("cell").alias("at"), F.col("a").alias("rep"))
             .union(pairs.select(F.col("cell").alias("at"), F.col("b").alias("rep")))
             .distinct().join(sets.select("rep", "members"), "rep"))
    return (pairs.groupBy("cell").cogroup(named.select("at", "rep", "members").groupBy("at"))
            .applyInArrow(_confirmed, "a long, b long"))


def _cell(cells: int, *keys: str):
    return F.pmod(F.xxhash64(*keys), F.lit(cells)).alias("cell")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    text_key: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row, text_key, component): one row per row of
    ``docs``. ``kept`` marks rows whose id is the component's; ``row`` numbers the rows;
    ``text_key`` is null, or a digest of the text if asked for. ``component`` names the
    component by a row of it, so components without ids or that share an id stay apart."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary")) if text_key else F.lit(None).cast("string")
    signed = written(docs.select("doc_id", "text", digest.alias("text_key")).mapInArrow(_signed, (
        "doc_id long, n_shingles long, k1 long, k2 long, left array<bigint>, tags binary, sketch binary, "
        "text_key string"))
        .withColumn("row", F.monotonically_increasing_id()), "neardup-signed")
    key = ["n_shingles", "k1", "k2"]
    full = signed.filter("n_shingles > 0")
    # one class for each set; its least row stands for it
    reps = written(full.groupBy(*key).agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("class_id"),
        *(F.first(c).alias(c) for c in ("left", "tags", "sketch"))), "neardup-reps")
    groups = reps.select("rep", F.posexplode("left").alias("i", "key"))
    # only groups of two and more can link; large ones are split into blocks
    sizes = groups.groupBy("i", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / GROUP_ROWS).cast("int")
    groups = written(groups.join(sizes, ["i", "key"]).select("i", "key", "rep", blocks.alias("blocks"))
                     .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")),
                     "neardup-groups")
    cells = -(-groups.count() // CELL_ROWS) or 1
    signs = reps.select("rep", "n_shingles", "tags")
    star = (groups.join(signs, "rep").groupBy(_cell(cells, "i", "key", "block"))
            .applyInArrow(_star_pairs, "a long, b long").distinct())
    members = groups.select("rep").distinct()
    # the sets of all documents that share a group with another one
    wanted = members.join(reps, "rep").select("rep", "class_id", *key)
    sets = written(_wanted_sets(docs, signed, wanted), "neardup-sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    sides = max(4, -(-2 * total // CELL_SHINGLES))
    links = written(_verify(star, sets, sides), "neardup-links")
    first = written(connected_components(links), "neardup-first")
    second = first
    for k in range(PARTNER_ROUNDS + 1):
        partners = k < PARTNER_ROUNDS
        labelled = (groups.join(second, groups.rep == second.node, "left").drop("node")
                    .withColumn("component", F.coalesce("component", "rep")))
        # groups of one component have nothing left to find
        mixed = (labelled.groupBy("i", "key").agg(F.min("component").alias("lo"),
                                                  F.max("component").alias("hi"))
                 .filter("lo < hi").select("i", "key"))
        left = (labelled.join(mixed, ["i", "key"])
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")))
        cross = (left.join(reps.select("rep", "n_shingles", "tags", "sketch"), "rep")
                 .groupBy(_cell(cells, "i", "key", "x", "y"))
                 .applyInArrow(_partner_pairs if partners else _cross_pairs, "a long, b long").distinct())
        late = written(_verify(cross, sets, sides), "neardup-links")
        if late.head(1):
            links = links.union(late)
            second = written(connected_components(links), "neardup-components")
    named = (reps.join(second, reps.rep == second.node, "left")
             .withColumn("component", F.coalesce("component", "rep"))
             .select(*key, "component", "class_id"))
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    classes = named.join(least, "component").select(*key, "component_id", "component")
    out = (full.select("doc_id", "row", "text_key", *key).join(classes, key)
           .select("doc_id", "n_shingles", "component_id", "row", "text_key", "component"))
    alone = signed.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row", "text_key",
        F.col("row").alias("component"))
    out = out.union(alone)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row", "text_key",
                      "component")


IDS_BOUND = 2_000_000


def _wanted_sets(docs: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, n_shingles, members): the full sets of the wanted classes, made anew from the
    texts of one row of each. Texts are found by id (ids need not be unique: the set's own
    name decides); the ids are broadcast up to ``IDS_BOUND`` of them, joined by a shuffle
    beyond."""
    key = ["n_shingles", "k1", "k2"]
    ids = (signed.join(wanted.select("rep"), signed.row == F.col("rep"), "left_semi")
           .select("doc_id").distinct())
    few = ids.count() <= IDS_BOUND
    side = F.broadcast(ids) if few else ids
    mine = docs.join(side.withColumnRenamed("doc_id", "w"),
                     docs.doc_id.eqNullSafe(F.col("w")), "left_semi").select("text")
    made = mine.mapInArrow(_rehashed, "n_shingles long, k1 long, k2 long, members binary")
    made = made.join(wanted.select("rep", *key), key)
    return made.groupBy("rep").agg(F.first("n_shingles").alias("n_shingles"),
                                   F.first("members").alias("members"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that with the least id; of
    rows that repeat it with one text any one, of several texts the one numbered first.
    Rows without words all stay."""
    marked = written(near_duplicates(docs, id_col, text_col, text_key=True), "neardup-marked")
    worded = marked.filter("n_shingles > 0")
    key = F.struct("doc_id", "text_key")
    # the least non-null id of a component; only then the rows without an id
    stays = worded.groupBy("component").agg(F.min_by(key, F.struct(
        F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("k")).select("k.*")
    same = lambda a, b: (F.col(f"{a}doc_id").eqNullSafe(F.col(f"{b}doc_id"))
                         & (F.col(f"{a}text_key") == F.col(f"{b}text_key")))
    gone = written(worded.select("doc_id", "text_key").distinct().join(
        stays.toDF("s_doc_id", "s_text_key"), same("", "s_"), "left_anti").toDF("__g_doc_id", "__g_text_key"), "neardup-gone")
    side = F.broadcast(gone) if gone.count() <= IDS_BOUND else gone
    keyed = docs.select(*docs.columns, F.col(id_col).cast("long").alias("__doc_id"),
                        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("__text_key"))
    left = keyed.join(side, same("__", "__g_"), "left_anti")
    # rows that repeat both id and text: one of each
    twice = written(worded.groupBy("doc_id", "text_key").count().filter("count > 1")
                    .select(F.col("doc_id").alias("__g_doc_id"), F.col("text_key").alias("__g_text_key")), "neardup-twice")
    if twice.head(1):
        again = left.join(twice, same("__", "__g_"), "left_semi").dropDuplicates(["__doc_id", "__text_key"])
        left = left.join(twice, same("__", "__g_"), "left_anti").union(again)
    return left.select(*docs.columns)
