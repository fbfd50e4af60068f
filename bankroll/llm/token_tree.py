"""Edit-aware token counts: pre-token segment trees per document.

``build`` cuts every text into pre-tokens (the tokenizer's own pattern) and counts the
tokens of each by byte-pair encoding; the state of a document is its text and two leaf
lists (characters and tokens of each pre-token). ``apply_edits`` puts a segment tree of
both sums over blocks of leaves, finds the leaves that an edit touches by descending it,
and encodes only these anew, with boundary context:

* to the left, the leaves that end less than ``MARGIN`` characters before the edit (the
  pattern looks at most two characters beyond a pre-token's end and never back), and
* to the right, leaves until a new boundary falls on an old one (from there on the text,
  and so the cutting, is the same).

The blocks touched are rewritten and the sums above them updated.

Cases: null texts and null edit lists are empty. Edits apply in order, each to the text as
it then is; offsets are code points, clipped to the text, and an end before the start is
taken as the start; a null replacement is empty.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, list_array, text_batches

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts a text before the merges of this rank file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARGIN = 3
BLOCK = 64               # leaves of a block
KNOWN = 500_000          # pre-tokens whose count a worker remembers (for speed only)
EDIT = "struct<start:int,end:int,replacement:string>"
LEAVES = T.ArrayType(T.IntegerType())


class Counter:
    """Pre-tokens of texts and their token counts."""

    def __init__(self, ranks: bytes) -> None:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.cut = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}

    def counts(self, parts: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [p for p in set(parts) if p not in self.known]
        encode = self.encoding.encode_ordinary
        for p in new:
            self.known[p] = len(encode(p))
        return np.fromiter(map(self.known.__getitem__, parts), np.int32, len(parts))


def _counter(ranks: bytes) -> Counter:
    return held("counter", ranks, lambda: Counter(ranks))


class Tree:
    """Segment tree over blocks of leaves; every node holds (characters, tokens)."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, counter: Counter) -> None:
        self.text, self.counter, self.encoded = text, counter, 0
        self._build(chars, tokens)

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.chars, self.tokens = chars, tokens
        n = max(1, -(-len(chars) // BLOCK))
        self.size = 1 << (n - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        if len(chars):
            heads = np.arange(0, len(chars), BLOCK)
            both = np.stack([chars, tokens], 1).astype(np.int64)
            self.sums[self.size:self.size + len(heads)] = np.add.reduceat(both, heads, axis=0)
        level = self.size
        while level > 1:
            self.sums[level // 2:level] = self.sums[level:2 * level:2] + self.sums[level + 1:2 * level:2]
            level //= 2
        # of a block: where it lies in the text as built, or its leaves if it was rewritten
        self.offset = np.r_[0, np.cumsum(self.sums[self.size:, 0])]
        self.rewritten: dict[int, tuple[list[str], list[int]]] = {}
        self.blocks = n

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    def leaves(self, block: int) -> tuple[list[str], list[int]]:
        if block not in self.rewritten:
            at, out = int(self.offset[block]), []
            sizes = self.chars[block * BLOCK:(block + 1) * BLOCK].tolist()
            for size in sizes:
                out.append(self.text[at:at + size])
                at += size
            return out, self.tokens[block * BLOCK:(block + 1) * BLOCK].tolist()
        return self.rewritten[block]

    def find(self, place: int) -> tuple[int, int]:
        """(block, characters before it) of the block that holds the character ``place``;
        the last block that has leaves for a place at the end."""
        place = min(place, self.n_chars - 1)
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if place - before >= self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        return node - self.size, before

    def _set(self, block: int, parts: list[str], counts: list[int]) -> None:
        self.rewritten[block] = (parts, counts)
        node = self.size + block
        self.sums[node] = (sum(map(len, parts)), sum(counts))
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, end: int, replacement: str) -> None:
        total = self.n_chars
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        if not total:
            parts = self.counter.cut(replacement)
            self._write(0, 0, parts, self.counter.counts(parts).tolist())
            self.encoded += len(parts)
            return
        low, before = self.find(max(0, start - MARGIN))
        high, _ = self.find(end)
        parts, counts = self.leaves(low)
        # leaves that end MARGIN characters or more before the edit stay
        at, keep = before, 0
        while keep < len(parts) and at + len(parts[keep]) + MARGIN <= start:
            at += len(parts[keep])
            keep += 1
        head, head_counts = parts[:keep], counts[:keep]
        old, old_counts = parts[keep:], counts[keep:]
        for block in range(low + 1, high + 1):
            more = self.leaves(block)
            old, old_counts = old + more[0], old_counts + more[1]
        reach = 8
        while True:
            # leaves after the edit that join the text to be cut again
            bounds = np.r_[at, at + np.cumsum([len(p) for p in old], dtype=np.int64)]
            last = int(np.searchsorted(bounds, end))
            stop = min(last + reach, len(old))
            if stop < last + reach and high + 1 < self.blocks:
                high += 1
                more = self.leaves(high)
                old, old_counts = old + more[0], old_counts + more[1]
                continue
            text = "".join(old[:stop])
            fresh = text[:start - at] + replacement + text[end - at:]
            ends_text = stop == len(old) and high + 1 >= self.blocks
            cut = self.counter.cut(fresh)
            shift = len(replacement) - (end - start)
            old_ends = set((bounds[last:stop + 1] + shift).tolist())
            limit = at + len(fresh) - (0 if ends_text else MARGIN)
            place, taken, back = at, 0, None
            if start == end == at and not replacement:
                back = at
            for part in cut:
                place += len(part)
                taken += 1
                if place >= start + len(replacement) and place in old_ends and place <= limit:
                    back = place
                    break
            if back is None and ends_text:
                taken, back = len(cut), at + len(fresh)
            if back is not None:
                break
            reach *= 2
        new = cut[:taken]
        self.encoded += len(new)
        rest = int(np.searchsorted(bounds, back - shift)) if len(old) else 0
        self._write(low, high, head + new + old[rest:],
                    head_counts + self.counter.counts(new).tolist() + old_counts[rest:])

    def _write(self, low: int, high: int, parts: list[str], counts: list[int]) -> None:
        """Spread the leaves over the blocks low..high; build anew if they hold too many."""
        n = high - low + 1
        each = -(-len(parts) // n)
        for k in range(n):
            self._set(low + k, parts[k * each:(k + 1) * each], counts[k * each:(k + 1) * each])
        if each > 4 * BLOCK:
            text, chars, tokens = self.state()
            self.text = text
            self._build(chars, tokens)

    def state(self) -> tuple[str, np.ndarray, np.ndarray]:
        if not self.rewritten:
            return self.text, self.chars, self.tokens
        text, chars, tokens, at = [], [], [], 0
        for block in sorted(self.rewritten):
            text.append(self.text[int(self.offset[at]):int(self.offset[block])])
            chars.append(self.chars[at * BLOCK:block * BLOCK])
            tokens.append(self.tokens[at * BLOCK:block * BLOCK])
            parts, counts = self.rewritten[block]
            text.append("".join(parts))
            chars.append(np.array([len(p) for p in parts], np.int32))
            tokens.append(np.array(counts, np.int32))
            at = block + 1
        text.append(self.text[int(self.offset[min(at, len(self.offset) - 1)]):])
        chars.append(self.chars[at * BLOCK:])
        tokens.append(self.tokens[at * BLOCK:])
        return "".join(text), np.concatenate(chars).astype(np.int32), np.concatenate(tokens).astype(np.int32)


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
          more: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, leaf_chars, leaf_tokens, n_tokens, ``more`` columns): the state of every
    document. The rank file (under 1 MB) is read by the driver and sent with the job."""
    data = read_ranks(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(data)
        for batch in text_batches(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            parts: list[str] = []
            n = np.zeros(len(texts), np.int64)
            for k, text in enumerate(texts):
                cut = counter.cut(text)
                parts += cut
                n[k] = len(cut)
            tokens = counter.counts(parts)
            chars = np.fromiter(map(len, parts), np.int32, len(parts))
            so_far = np.r_[0, np.cumsum(tokens, dtype=np.int64)]
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(texts, pa.string()), list_array(chars, n, pa.int32()),
                list_array(tokens, n, pa.int32()), pa.array(so_far[ends] - so_far[ends - n]),
                *(batch.column(c) for c in more)],
                ["id", "text", "leaf_chars", "leaf_tokens", "n_tokens", *more])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *more)
    schema = docs.select("id", "text").schema.add("leaf_chars", LEAVES).add("leaf_tokens", LEAVES).add(
        "n_tokens", "long")
    for c in more:
        schema = schema.add(docs.schema[c])
    return docs.mapInArrow(run, schema)


def with_edits(state: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``state`` with the edit list of each id from a table (id_col, seq, start, end,
    replacement); documents without edits get none."""
    lists = edits.groupBy(F.col(id_col).alias("__id")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "start", "end", "replacement"))),
        lambda e: F.struct(e["start"].cast("int").alias("start"), e["end"].cast("int").alias("end"),
                           e["replacement"].alias("replacement"))).alias("edits"))
    return state.join(lists, F.col("id") == F.col("__id"), "left").drop("__id")


def apply_edits(state: DataFrame, ranks: str = RANKS, keep_state: bool = True) -> DataFrame:
    """The state after each document's ``edits`` (a list of EDIT), with ``n_tokens_before``,
    ``n_edits`` and ``n_encoded``, the pre-tokens that were encoded anew. ``keep_state=False``
    returns the counts only."""
    data = read_ranks(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(data)
        for batch in text_batches(batches, "text"):
            chars, tokens = (_lists(batch.column(c)) for c in ("leaf_chars", "leaf_tokens"))
            rows = []
            for k, (text, edits) in enumerate(zip(batch.column("text").to_pylist(),
                                                  batch.column("edits").to_pylist())):
                tree = Tree(text or "", chars[k], tokens[k], counter)
                before = tree.n_tokens
                for e in edits or ():
                    tree.edit(e["start"] or 0, e["end"] or 0, e["replacement"] or "")
                rows.append((before, tree.n_tokens, len(edits or ()), tree.encoded,
                             tree.state() if keep_state else None))
            counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            out = [batch.column("id"), *counts]
            if keep_state:
                out += [pa.array([r[4][0] for r in rows], pa.string()),
                        *(list_array(np.concatenate([r[4][k] for r in rows]),
                                     np.array([len(r[4][k]) for r in rows]), pa.int32()) for k in (1, 2))]
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded"]
    schema = state.select("id").schema
    for c in names[1:]:
        schema = schema.add(c, "long")
    if keep_state:
        names += ["text", "leaf_chars", "leaf_tokens"]
        schema = schema.add("text", "string").add("leaf_chars", LEAVES).add("leaf_tokens", LEAVES)
    return state.select("id", "text", "leaf_chars", "leaf_tokens", "edits").mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
