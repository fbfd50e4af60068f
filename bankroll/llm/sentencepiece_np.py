"""SentencePiece encoding and decoding in numpy, over the pieces of a public model file.

Encoding finds, for each text, the segmentation of highest summed piece score (Viterbi).
Words of equal length advance together: the hashes of all their substrings are probed in
the sorted hashes of the pieces of that length, and one vectorised maximum per position
stores the backpointers. Characters that no piece covers become the byte pieces of their
UTF-8 form (each such character scores below every piece), so decoding gives the text back exactly.

The model's normaliser must be the identity with escaped white space (U+0020 becomes
U+2581; a leading U+2581 is added to a text that is not empty if the model says so, and
decoding drops it), and no piece may hold U+2581 after another character; both are
checked. So a text may be cut before each U+2581 that follows another character: the best
segmentation of the text is that of its words.

Memory stays bounded at any length of a text or word: a worker encodes about 1 MB of text at
once (a longer text stands alone), remembers words up to 24 MB, and of a position keeps only the piece taken.

Cases: an empty table gives no rows, repeated rows come out repeated, extra columns are not
looked at. A text that holds U+2581 itself is decoded with a space there, as the library does; the
flag ``round_trip`` is false for it. Null texts are empty: no ids. Ties go to the longer
last piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, list_array, ranges, text_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format (fixed values)
_WORD = re.compile(f"{SPACE}*[^{SPACE}]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
BITS = 18
BLOCK_CELLS = 1 << 19      # (word, position, length) cells of one Viterbi block
KNOWN_BYTES = 24 << 20     # of words whose ids a worker remembers (for speed only)
WORD_BYTES = 320           # of one such word: its text, its entry, its number, its place
LONG = 2_048               # characters beyond which a word is cut where no piece reaches over
TEXT_BYTES = 1 << 20       # of text encoded at once


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message (public wire format)."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, data[at:at + size]
            at += size


class Pieces:
    """The piece table of a model file, ready for probing."""

    def __init__(self, model: bytes) -> None:
        self.text: list[str] = []
        scores, kinds = [], []
        for number, value in _fields(model):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif n == 3:
                        kind = v
                self.text.append(piece)
                scores.append(score)
                kinds.append(kind)
            elif number == 3:
                rule = dict(_fields(value))  # fields: 2 rules, 3 prefix, 4 trimming, 5 escaping
                if rule.get(2) or rule.get(4, 1) or not rule.get(5, 1):
                    raise ValueError("only models with the identity normaliser are supported")
                self.prefix = SPACE if rule.get(3, 1) else ""
        self.byte_id = np.zeros(256, np.int32)
        by_length: dict[int, list[int]] = {}
        for k, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_id[int(self.text[k][3:5], 16)] = k
            elif kind == NORMAL:
                if SPACE in self.text[k].lstrip(SPACE):
                    raise ValueError("a piece holds a space after another character")
                by_length.setdefault(len(self.text[k]), []).append(k)
        self.longest = max(by_length)
        score = np.array(scores)
        normal = [k for k, kind in enumerate(kinds) if kind == NORMAL]
        self.byte_score = float(score[normal].min()) - 10.0
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.keys, self.ids, self.scores, self.seen = {}, {}, {}, {}
        for length, ids in by_length.items():
            codes = np.array([[ord(c) for c in self.text[k]] for k in ids], np.uint64)
            h = (codes * self.power[length - 1::-1][:length]).sum(1, dtype=np.uint64)
            order = np.argsort(h)
            self.keys[length], self.ids[length] = h[order], np.array(ids, np.int32)[order]
            if (np.diff(self.keys[length]) == 0).any():
                raise ValueError("two pieces share a hash")
            self.scores[length] = score[self.ids[length]]
            self.seen[length] = np.zeros(1 << BITS, bool)
            self.seen[length][(h * _BASE) >> np.uint64(64 - BITS)] = True
        self.bytes = {k: bytes([b]) for b, k in enumerate(self.byte_id.tolist())}
        self.sizes = np.array([len(t) for t in self.text])
        self.points = np.zeros((len(self.text), self.sizes.max()), np.uint64)
        for k, t in enumerate(self.text):
            self.points[k, :len(t)] = [ord(c) for c in t]
        self._forget()

    def _probe(self, codes: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) [word, end, length-1] of the pieces that end at each position from
        ``first`` on."""
        words, size = codes.shape
        most = min(size, self.longest)
        score = np.full((words, size - first, most), -np.inf)
        piece = np.full((words, size - first, most), -1, np.int32)
        run = np.zeros((words, size), np.uint64)  # hash of the last `length` characters
        for length in range(1, most + 1):
            run[:, length - 1:] = run[:, length - 1:] + codes[:, :size - length + 1] * self.power[length - 1]
            if length not in self.keys:
                continue
            low = max(first, length - 1)
            here = run[:, low:]
            maybe = np.nonzero(self.seen[length][(here * _BASE) >> np.uint64(64 - BITS)])
            h = here[maybe]
            at = np.minimum(np.searchsorted(self.keys[length], h), len(self.keys[length]) - 1)
            hit = self.keys[length][at] == h
            w, e, at = maybe[0][hit], maybe[1][hit] + low - first, at[hit]
            score[w, e, length - 1] = self.scores[length][at]
            piece[w, e, length - 1] = self.ids[length][at]
        return score, piece

    def _equal(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, number of ids of each) of words of one length. The forward pass goes
        over slices of positions; of each position only the piece taken stays."""
        size, rows = len(words[0]), np.arange(len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), size)
        most = min(size, self.longest)
        back = np.zeros((len(words), size), np.int16)
        taken = np.zeros((len(words), size), np.int32)
        step = max(1, BLOCK_CELLS // (len(words) * most))
        tail = np.full((len(words), most), -np.inf)  # the best sums of the last `most` prefixes
        tail[:, -1] = 0.0
        for low in range(0, size, step):
            high, since = min(size, low + step), max(0, low - most + 1)
            score, piece = self._probe(codes[:, since:high].astype(np.uint64), low - since)
            short = most - score.shape[2]  # a first slice of fewer positions than the longest piece
            if short:
                score = np.pad(score, ((0, 0), (0, 0), (0, short)), constant_values=-np.inf)
                piece = np.pad(piece, ((0, 0), (0, 0), (0, short)), constant_values=-1)
            alone = score[:, :, 0]
            score[:, :, 0] = np.where(np.isneginf(alone), self.byte_score, alone)  # no piece: its bytes
            best = np.concatenate([tail, np.full((len(words), high - low), -np.inf)], axis=1)
            for k in range(high - low):
                # of equal sums the longest last piece: lengths run downwards
                sums = best[:, k:k + most] + score[:, k, ::-1]
                take = sums.argmax(1)
                best[:, most + k] = sums[rows, take]
                back[:, low + k] = most - take
                taken[:, low + k] = piece[rows, k, most - 1 - take]
            tail = best[:, -most:].copy()
        owner, place = self._ways(back)
        ids = taken[owner, place]
        self._check(codes, owner, ids, place)
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            points = codes[owner[bare], place[bare]]
            utf8 = np.frombuffer(points.tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
            times = np.ones(len(ids), np.int64)
            times[bare] = 1 + sum((points >= least).astype(np.int64) for least in (0x80, 0x800, 0x10000))
            owner, ids = np.repeat(owner, times), np.repeat(ids, times)
            ids[ids < 0] = self.byte_id[utf8]
        return ids, np.bincount(owner, minlength=len(words))

    def _parts(self, word: str) -> list[str]:
        """A long word cut where no piece reaches over the cut: the best segmentation of the
        word is that of its parts."""
        codes = np.frombuffer(word.encode("utf-32-le"), "<u4").reshape(1, -1)
        over = np.zeros(len(word) + 1, np.int32)  # pieces that begin to, and cease to, reach over a place
        step = max(1, BLOCK_CELLS // self.longest)
        for low in range(0, len(word), step):
            since = max(0, low - self.longest + 1)
            _, piece = self._probe(codes[:, since:low + step].astype(np.uint64), low - since)
            end, length = np.nonzero(piece[0, :, 1:] >= 0)
            np.add.at(over, low + end - length, 1)
            np.add.at(over, low + end + 1, -1)
        cuts = np.flatnonzero(np.cumsum(over) == 0).tolist()
        return [word[a:b] for a, b in zip([0] + cuts, cuts) if b > a]

    @staticmethod
    def _ways(back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, position) of the ends of the pieces taken, in order."""
        words, size = back.shape
        ends = np.zeros(back.shape, bool)
        if words == 1:  # one long word: a step a piece
            lengths, mark, at = back[0].tobytes(), bytearray(size), size
            lengths = memoryview(lengths).cast("h")
            while at:
                mark[at - 1] = 1
                at -= lengths[at - 1]
            ends[0] = np.frombuffer(mark, bool)
        else:  # all words together
            at, live = np.full(words, size), np.arange(words)
            while len(live):
                end = at[live] - 1
                ends[live, end] = True
                at[live] = end + 1 - back[live, end]
                live = live[at[live] > 0]
        return np.nonzero(ends)

    def _check(self, codes: np.ndarray, owner: np.ndarray, ids: np.ndarray, place: np.ndarray) -> None:
        """A chance equality of hashes would show here: the pieces taken must spell the words."""
        known = ids >= 0
        owner, ids, place = owner[known], ids[known], place[known]
        size = self.sizes[ids]
        for k in range(int(size.max(initial=0))):
            has = size > k
            if not np.array_equal(self.points[ids[has], k], codes[owner[has], place[has] - size[has] + 1 + k]):
                raise ValueError("a substring has the hash of another piece")

    def _learn(self, new: list[str]) -> None:
        """Encode the words and append them to the table of known words."""
        new.sort(key=len)
        flat, lengths = [self.flat], [self.lengths]
        at = 0
        while at < len(new):
            size = len(new[at])
            most = max(1, BLOCK_CELLS // (size * min(size, self.longest)))
            stop = at + 1
            while stop < len(new) and stop - at < most and len(new[stop]) == size:
                stop += 1
            ids, counts = self._equal(new[at:stop])
            flat.append(ids.astype(np.int32))
            lengths.append(counts)
            at = stop
        for w in new:
            self.number[w] = len(self.number)
            self.chars += 4 * len(w)
        self.flat, self.lengths = np.concatenate(flat), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.starts = self.lengths
        self.chars = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, number of ids of each)."""
        if WORD_BYTES * len(self.number) + self.chars + self.flat.nbytes > KNOWN_BYTES:
            self._forget()
        words: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            if text:
                own = _WORD.findall(self.prefix + text.replace(" ", SPACE))
                own.pop()  # the last match is empty
                for w in own:
                    if len(w) > LONG:
                        words += self._parts(w)
                    else:
                        words.append(w)
            ends[k + 1] = len(words)
        new = [w for w in set(words) if w not in self.number]
        if new:
            self._learn(new)
        codes = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[codes]
        ids = self.flat[ranges(self.starts[codes], lengths)]
        return ids, np.diff(np.r_[0, np.cumsum(lengths)][ends])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids. Bytes that are no UTF-8 become U+FFFD."""
        if not hasattr(self, "raw"):
            raw = [self.bytes.get(k) or t.replace(SPACE, " ").encode("utf-8") for k, t in enumerate(self.text)]
            self.raw = np.frombuffer(b"".join(raw), np.uint8)
            self.raw_size = np.array([len(r) for r in raw], np.int64)
            self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        out, at = [], 0
        for n in counts.tolist():
            parts = []
            for low in range(at, at + n, TEXT_BYTES):
                some = ids[low:min(at + n, low + TEXT_BYTES)]
                parts.append(self.raw[ranges(self.raw_start[some], self.raw_size[some])].tobytes())
            text = b"".join(parts).decode("utf-8", "replace")
            out.append(text[1:] if self.prefix and text[:1] == " " else text)
            at += n
        return out


def _pieces(model: bytes) -> Pieces:
    return held("pieces", model, lambda: Pieces(model))


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           model: str = MODEL) -> DataFrame:
    """(id_col, token_ids, n_tokens, round_trip): one row per row of ``docs``; the ids of
    the whole text, and whether decoding them gives it back. The model file (under 1 MB) is
    read by the driver and sent with the job."""
    data = read_model(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(data)
        for batch in text_batches(batches, "text", TEXT_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, counts = pieces.encode(texts)
            same = [a == b for a, b in zip(pieces.decode(ids, counts), texts)]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), list_array(ids, counts, pa.int32()),
                pa.array(counts, pa.int64()), pa.array(same)],
                ["id", "token_ids", "n_tokens", "round_trip"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return (docs.mapInArrow(run, f"id {kind}, token_ids array<int>, n_tokens long, round_trip boolean")
            .withColumnRenamed("id", id_col))


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids",
           model: str = MODEL) -> DataFrame:
    """(id_col, text): the text of each row's ids; a null list is an empty text. Ids outside
    the table are refused."""
    data = read_model(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(data)
        for batch in batches:
            rows = [r or [] for r in batch.column("ids").to_pylist()]
            counts = np.array([len(r) for r in rows], np.int64)
            ids = np.array([k for r in rows for k in r], np.int64)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(pieces.text)):
                raise ValueError("an id is outside the piece table")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(pieces.decode(ids, counts), pa.string())], ["id", "text"])

    tokens = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = tokens.schema["id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
