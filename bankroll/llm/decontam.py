"""Benchmark decontamination by SimHash of item-sized windows.

Window lengths form a geometric grid; an item is represented by its stretches of the largest
grid length that is at most ``SHARE`` of its own, one from every word on. Documents are read
in windows of these lengths at a stride of two thirds of the room that such a stretch has in
an item, so a document that holds an item always has a window, mostly two, that lies exactly
on a stretch of it. A window's fingerprint is the SimHash of its words (rarer words of the benchmark
weigh more); the sums over the words before a place, eight or four of them in one number,
make a window one subtraction.

A fingerprint has four blocks of 16 bits. For groups of item fingerprints tables hold, for
each block value, the least distance to the group's values: if a window lies within
``RADIUS`` of a member, the sum of its four table values is no larger, so no fingerprint
within the radius is lost. Windows that pass are compared with the group's members, and the
documents they name are verified: the weighted Jaccard similarity of the distinct five-word
shingles of the item and of a stretch of the document, of any place and length, must be
0.75 or more. A shingle weighs one over the number of items that
hold it.

Cases: null or empty texts, and items without words, match nothing. An item of fewer than
five words has one shingle, and is looked up by it among all runs of so many words. A document shorter than a window is one window itself. Items
that repeat are all reported. Whole documents are read; items are handled in blocks of
``ITEMS_AT_ONCE``, with weights counted over the whole benchmark, so it may be of any size
and the blocks do not show in the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnp
from .common import held, string_buffers, text_batches

GRID, SHARE = 1.25, 0.75
RADIUS = 12
SLACK = 2                  # words; no bound here: the plain versions in the tests try stretches so far off
LEAST = 75                 # per cent
HEAVIEST = 4
ITEMS_AT_ONCE = 5_000
GROUP = 32                 # item fingerprints of one set of tables
WORDS_AT_ONCE = 1 << 15
BLOCKS = 4
SEEN_BITS = 20


def grid(most: int) -> list[int]:
    """Window lengths 1, 2, ... up to ``most``, each about GRID times the one before."""
    out, x = [1], 1.0
    while out[-1] < most:
        x = max(x * GRID, out[-1] + 1)
        out.append(int(x))
    return out


def _spread(lanes: int) -> np.ndarray:
    """[weight, value of ``lanes`` bits]: the weight in the lane of every set bit. A lane is
    64 / lanes bits wide."""
    value = np.arange(1 << lanes, dtype=np.uint64)
    out = np.zeros((HEAVIEST + 1, 1 << lanes), np.uint64)
    for bit in range(lanes):
        out += (np.arange(HEAVIEST + 1, dtype=np.uint64)[:, None]
                * ((value >> np.uint64(bit)) & np.uint64(1)) << np.uint64(64 // lanes * bit))
    return out


_LANES = {8: _spread(8), 4: _spread(4)}


class _Sums:
    """Weights of the set hash bits, summed over the words before each place. The sums wrap;
    differences of windows whose lanes do not overflow are exact."""

    def __init__(self, word_hash: np.ndarray, weight: np.ndarray, lanes: int) -> None:
        self.lanes = lanes
        part = word_hash.view(np.uint8).reshape(-1, 8)
        if lanes == 4:
            part = np.stack([part & 15, part >> 4], 2).reshape(len(word_hash), 16)
        self.sums = np.zeros((part.shape[1], len(word_hash) + 1), np.uint64)
        for k in range(part.shape[1]):
            np.cumsum(_LANES[lanes][weight, part[:, k]], out=self.sums[k, 1:])
        self.weight = np.zeros(len(word_hash) + 1, np.int64)
        np.cumsum(weight, out=self.weight[1:])

    def prints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints [BLOCKS, window] of the words start..end of each window: the bits that
        more than half of the weight sets."""
        held = np.take(self.sums, end, axis=1)
        held -= np.take(self.sums, start, axis=1)
        half = ((self.weight[end] - self.weight[start]) >> 1).astype(np.uint64)
        # a lane's top bit is set by adding what half lacks to it; the top bits are then
        # drawn together by a multiplication
        if self.lanes == 8:
            held += (np.uint64(127) - half) * np.uint64(0x0101010101010101)
            held &= np.uint64(0x8080808080808080)
            held *= np.uint64(0x0002040810204081)
            held >>= np.uint64(56)
        else:
            held += (np.uint64(32767) - half) * np.uint64(0x0001000100010001)
            held &= np.uint64(0x8000800080008000)
            held *= np.uint64(0x0000200040008001)
            held >>= np.uint64(60)
            held = held[0::2] | (held[1::2] << np.uint64(4))
        held = held.astype(np.uint16)
        return held[0::2] | (held[1::2] << np.uint16(8))


def _lanes(size: int) -> int:
    return 8 if size * HEAVIEST < 128 else 4


class _Known:
    """Lookup of 64-bit keys; most keys asked for are not known."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, other) -> None:
        self.keys, self.values, self.other = keys, values, other
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[keys >> np.uint64(64 - SEEN_BITS)] = True

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        out = np.full(len(asked), self.other, self.values.dtype)
        if not len(self.keys):
            return out
        maybe = np.flatnonzero(self.seen[asked >> np.uint64(64 - SEEN_BITS)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, asked[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == asked[maybe]
            out[maybe[hit]] = self.values[at[hit]]
        return out


class _Stretches:
    """The stretches of one length of the items that this length represents."""

    def __init__(self, size: int, places: list[tuple[int, int]], prints: np.ndarray, stride: int) -> None:
        self.size, self.stride = size, stride
        self.item = np.array([k for k, _ in places])
        self.shift = np.array([s for _, s in places])
        self.whole = np.ascontiguousarray(prints.T).view(np.uint64)[:, 0]
        self.groups = [(low, [self._least(prints[b, low:low + GROUP]) for b in range(BLOCKS)])
                       for low in range(0, len(places), GROUP)]

    @staticmethod
    def _least(values: np.ndarray) -> np.ndarray:
        """For every block value the least distance to ``values``: spread from them bit by bit."""
        out = np.full(1 << 16, 16, np.uint8)
        out[values] = 0
        every = np.arange(1 << 16)
        for bit in range(16):
            out = np.minimum(out, out[every ^ (1 << bit)] + 1)
        return out.astype(np.uint8)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, stretch, distance) of those within the radius."""
        windows, found, distance = [], [], []
        whole = np.ascontiguousarray(prints.T).view(np.uint64)[:, 0]
        for low, least in self.groups:
            bound = least[0].take(prints[0])
            for b in range(1, BLOCKS):
                bound += least[b].take(prints[b])
            some = np.flatnonzero(bound <= RADIUS)
            if len(some):
                far = np.bitwise_count(whole[some][:, None] ^ self.whole[low:low + GROUP])
                at, which = np.nonzero(far <= RADIUS)
                windows.append(some[at])
                found.append(low + which)
                distance.append(far[at, which].astype(np.int64))
        return tuple(np.concatenate(x or [np.zeros(0, np.int64)]) for x in (windows, found, distance))


class Common:
    """What the whole benchmark shares: its number of items, the words that so many items hold
    that they weigh less than HEAVIEST, and the shingles of two and more items, with their
    numbers of items."""

    def __init__(self, items: int, words: np.ndarray, word_items: np.ndarray,
                 shingles: np.ndarray, shingle_items: np.ndarray) -> None:
        self.items = items
        self.words, self.word_items = _ascending(words, word_items)
        self.shingles, self.shingle_items = _ascending(shingles, shingle_items)

    def weights(self) -> tuple[_Known, _Known]:
        """Weights of words and of shingles; all others have the default."""
        light = np.ceil(-np.log2(self.word_items / max(1, self.items)))
        return (_Known(self.words, np.clip(light, 1, HEAVIEST).astype(np.int64), HEAVIEST),
                _Known(self.shingles, 1.0 / self.shingle_items, 1.0))


def _ascending(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def _distinct_of_items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, hash) of the distinct words (0) and shingles (1) of each item."""
    for batch in batches:
        for part in text_batches([batch], "text"):
            data, offsets = string_buffers(part.column("text"))
            start, end, first = textnp.words(data, offsets)
            words = textnp.hash_words(data, start, end)
            both = [textnp.distinct(words, first)[0], textnp.distinct(*textnp.shingles(words, first))[0]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(2, dtype=np.int32), [len(x) for x in both])),
                pa.array(np.concatenate(both).view(np.int64))], ["kind", "hash"])


def _common(items: DataFrame, n: int) -> Common:
    """Counted by Spark; what only one item holds, and words of few items, stay there."""
    held = (items.select("text").mapInArrow(_distinct_of_items, "kind int, hash long")
            .groupBy("kind", "hash").agg(F.count(F.lit(1)).alias("items"))
            .filter(F.when(F.col("kind") == 0, F.col("items") * (1 << (HEAVIEST - 1)) >= n)
                    .otherwise(F.col("items") > 1)).toArrow())
    kind = held.column("kind").to_numpy()
    keys, times = held.column("hash").to_numpy().view(np.uint64), held.column("items").to_numpy()
    return Common(n, keys[kind == 0], times[kind == 0], keys[kind == 1], times[kind == 1])


class Items:
    """A block of benchmark items, ready for probing. ``common`` tells what the whole
    benchmark shares; without it the block is the whole."""

    def __init__(self, ids: list, texts: list[str], common: Common | None = None) -> None:
        data, offsets = string_buffers(pa.array(texts, pa.string()))
        start, end, first = textnp.words(data, offsets)
        words = textnp.hash_words(data, start, end)
        n = np.diff(first)
        self.ids, self.length = ids, n
        hashes, bounds = textnp.distinct(*textnp.shingles(words, first))
        self.shingles = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        kinds = np.unique(hashes)
        if common is None:
            own, times = np.unique(hashes, return_counts=True)
            common = Common(len(n), *np.unique(textnp.distinct(words, first)[0], return_counts=True),
                            own[times > 1], times[times > 1])
        # words weigh by the number of items that hold them, shingles one over it
        self.weights, self.weigh = common.weights()
        self.shared = _Known(kinds, self.weigh(kinds), 0.0)
        self.total = np.array([self.weigh(s).sum() for s in self.shingles])
        # items shorter than a shingle: their one shingle, by number of words
        self.short: dict[int, dict[int, list[int]]] = {}
        for k in np.flatnonzero((n > 0) & (n < textnp.SHINGLE_WORDS)).tolist():
            self.short.setdefault(int(n[k]), {}).setdefault(int(self.shingles[k][0]), []).append(k)
        by_size: dict[int, list[int]] = {}
        sizes = grid(int(n.max(initial=1)))
        for k, w in enumerate(n.tolist()):
            if w >= textnp.SHINGLE_WORDS:
                by_size.setdefault(max(g for g in sizes if g <= max(1, SHARE * w)), []).append(k)
        self.sizes: dict[int, _Stretches] = {}
        for size, items in sorted(by_size.items()):
            places, prints = [], []
            for k in items:
                own = words[first[k]:first[k + 1]]
                at = np.arange(len(own) - size + 1)
                prints.append(_Sums(own, self.weights(own), _lanes(size)).prints(at, at + size))
                places += [(k, s) for s in at.tolist()]
            # of the shortest item that this length may represent, whichever are in the block
            room = max(textnp.SHINGLE_WORDS, -int(-size // SHARE)) - size + 1
            self.sizes[size] = _Stretches(size, places, np.concatenate(prints, 1), max(1, 2 * room // 3))

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's shingles and those of a window."""
        other, own = np.unique(shingles), self.shingles[item]
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        same = own[at] == other
        weight = self.weigh(other)
        return float(weight[same].sum() / (self.total[item] + weight[~same].sum()))

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(text, item, distance, first word) at which an item may lie, in this order."""
        weight = self.weights(words)
        n = np.diff(first)
        found = [np.zeros((0, 4), np.int64)]
        owner = np.repeat(np.arange(len(n)), n)

        def add(have: _Stretches, starts: np.ndarray, prints: np.ndarray) -> None:
            window, which, distance = have.near(prints)
            text = owner[starts[window]]
            at = np.maximum(starts[window] - have.shift[which], first[text])
            found.append(np.stack([text, have.item[which], distance, at], 1))

        most = max(self.sizes, default=0)
        for low in range(0, len(words), WORDS_AT_ONCE):
            high = min(len(words), low + WORDS_AT_ONCE + most)
            sums: dict[int, _Sums] = {}
            for size, have in self.sizes.items():
                lanes = _lanes(size)
                if lanes not in sums:
                    sums[lanes] = _Sums(words[low:high], weight[low:high], lanes)
                # strides are counted from each text's first word, and every text's last window is taken
                at = np.arange(low, min(low + WORDS_AT_ONCE, high - size + 1))
                if not len(at):
                    continue
                text = owner[at]
                left = first[text + 1] - at
                at = at[(left >= size) & (((at - first[text]) % have.stride == 0) | (left == size))]
                add(have, at, sums[lanes].prints(at - low, at - low + size))
        # texts shorter than a window, but long enough to be similar to an item
        for size, have in self.sizes.items():
            short = np.flatnonzero((n > 0) & (n < size) & (2 * n >= size))
            if len(short):
                prints = [_Sums(words[first[k]:first[k + 1]], weight[first[k]:first[k + 1]], _lanes(size))
                          .prints(np.zeros(1, np.int64), n[k:k + 1]) for k in short.tolist()]
                add(have, first[short], np.concatenate(prints, 1))
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, words: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
        """{(text, item): (similarity, first word in the text)} of the verified ones."""
        out = self._short_matches(words, first)
        found = self.candidates(words, first)
        if not len(found):
            return out
        hashes, own = textnp.shingles(words, first)
        shared = self.shared(hashes)
        known, before = np.flatnonzero(shared), np.r_[0.0, np.cumsum(shared)]
        pairs = np.unique(found[:, :2], axis=0)
        held = before[own[pairs[:, 0] + 1]] - before[own[pairs[:, 0]]]
        text = None
        for t, k in pairs[100 * held >= LEAST * self.total[pairs[:, 1]] - 1e-6].tolist():
            begin, end = int(own[t]), int(own[t + 1])
            if text is None or text.number != t:
                at = known[np.searchsorted(known, begin):np.searchsorted(known, end)] - begin
                text = _Text(t, hashes[begin:end], at)
            best = self._best(k, text)
            if best is not None:
                out[t, k] = best
        return out

    def _short_matches(self, words: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
        """Items shorter than a shingle lie where their words stand in a row: such a stretch
        is all of the item or shares nothing with it."""
        out: dict[tuple[int, int], tuple[float, int]] = {}
        for size, items in self.short.items():
            hashes, own = textnp.shingles(words, first, size)
            for at in np.flatnonzero(np.isin(hashes, np.array(list(items), np.uint64))).tolist():
                t = int(np.searchsorted(own, at, side="right")) - 1
                for k in items[int(hashes[at])]:
                    out.setdefault((t, k), (1.0, at - int(own[t])))
        return out

    def _best(self, item: int, text: _Text) -> tuple[float, int] | None:
        """(similarity, first word) of the stretch of a text most similar to an item, of any
        place and length, if that is similar enough."""
        own, total = self.shingles[item], float(self.total[item])
        at = text.known[np.isin(text.hashes[text.known], own)]
        if 100 * self.weigh(np.unique(text.hashes[at])).sum() < LEAST * total - 1e-6:
            return None
        # the best stretch begins and ends with shingles of the item, and none of them comes
        # again in it before its end: what precedes the last of them adds nothing
        weight = self.weigh(text.hashes)
        same = np.zeros(len(weight), bool)
        same[at] = True
        gain = np.r_[0.0, np.cumsum(np.where(same, weight, 0.0))]
        # shingles that are new to the text are new to every stretch; too many end it
        strange = np.r_[0.0, np.cumsum(np.where(same | (text.previous >= 0), 0.0, weight))]
        room = total * (100 / LEAST - 1) + 1e-6
        reach = np.minimum(np.searchsorted(strange, strange[at] + room, side="right") - 1, text.following[at])
        most = (gain[reach] - gain[at]) / total
        found, place = LEAST / 100 - 1e-9, None
        for start, end, bound in zip(at.tolist(), reach.tolist(), most.tolist()):
            if bound + 1e-9 < found or found > 1 - 1e-9:
                continue
            new = np.where(text.previous[start:end] < start, weight[start:end], 0.0)
            both = np.cumsum(np.where(same[start:end], new, 0.0))
            alike = both / (total + np.cumsum(new) - both)
            k = int(alike.argmax())
            if alike[k] > found or (place is None and alike[k] >= found):
                found, place = float(alike[k]), (start, start + k + 1)
        if place is None:
            return None
        return self.similarity(item, text.hashes[place[0]:place[1]]), place[0]


class _Text:
    """The shingles of one text, the places of those that some item holds, and for each the
    place at which it came before (-1: nowhere) and comes next (the text's end: nowhere)."""

    def __init__(self, number: int, hashes: np.ndarray, known: np.ndarray) -> None:
        self.number, self.hashes, self.known = number, hashes, known
        order = np.argsort(hashes, kind="stable")
        again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        self.previous = np.full(len(hashes), -1, np.int64)
        self.following = np.full(len(hashes), len(hashes), np.int64)
        self.previous[order[again + 1]] = order[again]
        self.following[order[again]] = order[again + 1]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, word): one row for each row of ``docs`` and item that
    lies in it; ``word`` is the place in the document's words."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = items.count()
    blocks = max(1, -(-n // ITEMS_AT_ONCE))
    # weights are those of the whole benchmark; the only block counts them itself
    common = _common(items, n) if blocks > 1 else None
    out = None
    for block in range(blocks):  # one scan of the documents for each block of items
        part = items if blocks == 1 else items.filter(
            F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        rows = sorted(part.collect(), key=lambda r: (r["id"] is None, r["id"] or 0, r["text"]))
        found = docs.mapInArrow(_run([r["id"] for r in rows], [r["text"] for r in rows], common),
                                "doc_id long, item_id long, similarity double, word long")
        out = found if out is None else out.union(found)
    return out


def _run(ids: list, texts: list[str], common: Common | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tuple(ids), tuple(texts), None if common is None else (
            common.items, *(x.tobytes() for x in (common.words, common.word_items,
                                                  common.shingles, common.shingle_items))))
        items = held("items", key, lambda: Items(ids, texts, common))
        for batch in text_batches(batches, "text"):
            data, offsets = string_buffers(batch.column("text"))
            start, end, first = textnp.words(data, offsets)
            found = items.matches(textnp.hash_words(data, start, end), first)
            own = batch.column("doc_id").to_pylist()
            keys = sorted(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([own[t] for t, _ in keys], pa.int64()), pa.array([ids[k] for _, k in keys], pa.int64()),
                pa.array([found[k][0] for k in keys], pa.float64()),
                pa.array([found[k][1] for k in keys], pa.int64())],
                ["doc_id", "item_id", "similarity", "word"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item lies. Rows that share an id with a
    contaminated one go with it; rows with a null id are judged by their text alone."""
    marked = docs.withColumn("__key", F.xxhash64(F.col(id_col), F.col(text_col)))
    found = contaminated(marked, benchmark, "__key", text_col).select(
        F.col("doc_id").alias("__bad")).distinct()
    return marked.join(found, F.col("__key") == F.col("__bad"), "left_anti").select(*docs.columns)
