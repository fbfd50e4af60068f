"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (3 to 5 characters of
``<word>``, and the whole word), looked up by hash in one table; so unseen misspellings
share vectors with the words they come from. A passage's vector is the mean over its words
(zero vectors fill up short ones; a word that repeats its predecessor is read once), and a
linear softmax gives its class. Documents are read as overlapping passages that
cover the whole text, and a document is as toxic as its most toxic passage. Table and
softmax are learned together: each step takes the passage of a document that scores highest
now (for label 0 as well as 1).

Training runs on the driver on a bounded sample (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents with the
least hashes of their ids, and of each at most ``SAMPLE_WORDS`` words: for longer texts
several stretches spread over the whole text). Scoring covers every word of every text.

Cases: a null or empty text, or one without letters, is scored by an empty passage (the
softmax's shift alone). Null labels are not learned from; with one class only the score is
its share (0.5 without labelled rows).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, text_batches
from .textnp import mix

GRAMS = (3, 4, 5)
SLOTS, DEPTH = 1 << 17, 8
PASSAGE, LEAST = 16, 8  # words; half of a passage overlaps the next; shorter ones are filled up
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_WORDS = 2_500, 6_000, 768
EPOCHS, LEAST_STEPS, ROWS, RATE = 8, 500, 128, 0.5
KNOWN_WORDS = 400_000  # words whose score a worker remembers (for speed only)
_WORDS = re.compile(r"[^\W\d_]+")
Weights = dict[str, np.ndarray]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, number of slots of each word)."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(w) for w in marked])
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    head = np.cumsum(size) - size
    slots, owners = [], []
    whole = np.zeros(len(words), np.uint64)
    for k in range(int(size.max(initial=0))):
        has = size > k
        whole[has] = mix(whole[has] + codes[head[has] + k] + np.uint64(k))
    slots.append(whole)
    owners.append(np.arange(len(words)))
    for g in GRAMS:
        n = np.maximum(size - g + 1, 0)
        at = ranges(head, n)
        h = np.full(len(at), np.uint64(g))
        for k in range(g):
            h = mix(h + codes[at + k])
        slots.append(h)
        owners.append(np.repeat(np.arange(len(words)), n))
    slot = (np.concatenate(slots) & np.uint64(SLOTS - 1)).astype(np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return slot[order], np.bincount(owner, minlength=len(words))


def _mean_rows(table: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    heads = np.cumsum(counts) - counts
    return np.add.reduceat(table[slots], heads, axis=0) / counts[:, None]


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def passages(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, owner) of the passages of texts of n words each, words counted
    through all texts; a text without words has one empty passage."""
    half = PASSAGE // 2
    count = np.maximum(1, -(-(n - half) // half))
    owner = np.repeat(np.arange(len(n)), count)
    at = ranges(np.zeros(len(n), np.int64), count) * half
    return (np.cumsum(n) - n)[owner] + at, np.maximum(0, np.minimum(PASSAGE, n[owner] - at)), owner


def _passage_values(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean of the values of the words of each passage; 0 for empty ones."""
    total = np.r_[0.0, np.cumsum(values)]
    return (total[first + size] - total[first]) / np.maximum(size, LEAST)


def _highest(margin: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The passage of highest margin of each text."""
    order = np.lexsort((np.arange(len(margin)), -margin, owner))
    return order[np.searchsorted(owner[order], np.arange(texts))]


def train(texts: list[list[str]], y: np.ndarray, seed: int = 11) -> Weights:
    r = np.random.default_rng(seed)
    number: dict[str, int] = {}
    codes = [np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in texts]
    codes = [c[np.r_[True, c[1:] != c[:-1]]] if len(c) else c for c in codes]
    slots, counts = subwords(list(number)) if number else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    heads = np.cumsum(counts) - counts
    w = {"table": r.normal(0, 1 / DEPTH, (SLOTS, DEPTH)), "out": r.normal(0, 0.1, (DEPTH, 2)),
         "shift": np.zeros(2)}
    seen = {k: np.full_like(v, 1e-8) for k, v in w.items()}  # sums of squares (Adagrad)
    # the toxic half weighs twice the clean half: a missed one costs more than a false alarm
    weight = np.where(y == 1, 2 * len(y) / (3 * max(1, y.sum())), len(y) / (3 * max(1, (1 - y).sum())))
    steps = max(1, len(texts) // ROWS)
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // steps))):
        for some in np.array_split(r.permutation(len(texts)), steps):
            n = np.array([len(codes[k]) for k in some])
            flat = np.concatenate([codes[k] for k in some]) if n.sum() else np.zeros(0, np.int64)
            kinds, back = np.unique(flat, return_inverse=True)
            taken = slots[ranges(heads[kinds], counts[kinds])]
            vectors = _mean_rows(w["table"], taken, counts[kinds]) if len(kinds) else np.zeros((0, DEPTH))
            first, size, owner = passages(n)
            margin = vectors @ (w["out"][:, 1] - w["out"][:, 0])
            if epoch == 0:  # before the margins mean anything: a passage by chance
                best = _highest(r.random(len(first)), owner, len(some))
            else:
                best = _highest(_passage_values(margin[back], first, size), owner, len(some))
            at, held = ranges(first[best], size[best]), size[best]
            own = np.repeat(np.arange(len(some)), held)
            bag = np.zeros((len(some), DEPTH))
            np.add.at(bag, own, vectors[back[at]])
            bag /= np.maximum(held, LEAST)[:, None]
            z = bag @ w["out"] + w["shift"]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = p.copy()
            d[np.arange(len(some)), y[some]] -= 1
            d *= weight[some][:, None] / len(some)
            dbag = d @ w["out"].T / np.maximum(held, LEAST)[:, None]
            dword = np.zeros_like(vectors)
            np.add.at(dword, back[at], dbag[own])
            dtaken = np.repeat(dword / counts[kinds][:, None], counts[kinds], axis=0) if len(kinds) else dword
            by = np.argsort(taken, kind="stable")
            rows, heads_of = np.unique(taken[by], return_index=True)
            drows = np.add.reduceat(dtaken[by], heads_of, axis=0) if len(rows) else dtaken
            seen["table"][rows] += drows * drows
            w["table"][rows] -= RATE * drows / np.sqrt(seen["table"][rows])
            for k, g in (("out", bag.T @ d), ("shift", d.sum(0))):
                seen[k] += g * g
                w[k] -= 0.2 * RATE * g / np.sqrt(seen[k])
    # only the difference of the two softmax rows is needed to score; a word's share of it
    # is the mean over its slots
    return {"slot": (w["table"] @ (w["out"][:, 1] - w["out"][:, 0])).astype(np.float32),
            "shift": w["shift"][1:] - w["shift"][:1]}


class Scorer:
    """Scores whole texts; remembers the words' shares (bounded)."""

    def __init__(self, w: Weights) -> None:
        self.w = w
        self.known: dict[str, float] = {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        words: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            found = words_of(t)
            words += found
            n[k] = len(found)
        new = [x for x in set(words) if x not in self.known]
        if new:
            slots, counts = subwords(new)
            heads = np.cumsum(counts) - counts
            self.known.update(zip(new, (np.add.reduceat(self.w["slot"][slots], heads) / counts).tolist()))
        values = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        own = np.repeat(np.arange(len(texts)), n)
        new_word = np.ones(len(words), bool)  # equal words have equal shares
        new_word[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
        values, n = values[new_word], np.bincount(own[new_word], minlength=len(texts))
        first, size, owner = passages(n)
        margin = _passage_values(values, first, size)
        most = np.full(len(texts), -np.inf)
        np.maximum.at(most, owner, margin)
        return 1 / (1 + np.exp(-np.clip(most + self.w["shift"][0], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", may_learn=None) -> Weights | float:
    """Weights learned from labelled rows for which ``may_learn`` (a column expression over
    ``id``) holds; the share of label 1 where there is only one class."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .filter("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").alias("y")))
    if may_learn is not None:
        marked = marked.filter(may_learn)
    chosen = None
    for label, most in ((0, SAMPLE_CLEAN), (1, SAMPLE_TOXIC)):
        part = marked.filter(F.col("y") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    most = SAMPLE_WORDS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text or "")
                if len(words) > most:  # stretches of 4 passages, evenly over the text
                    long = 4 * PASSAGE
                    heads = np.linspace(0, len(words) - long, most // long).astype(int)
                    words = [w for h in heads.tolist() for w in words[h:h + long]]
                rows.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(rows, pa.string())],
                                             ["id", "y", "words"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    rows = (docs.join(F.broadcast(chosen), "id").select("id", "y", "text")
            .mapInArrow(run, f"id {kind}, y int, words string").collect())
    rows.sort(key=lambda x: (x["id"], x["words"]))
    y = np.array([x["y"] for x in rows], np.int64)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    return train([x["words"].split() for x in rows], y)


def score(docs: DataFrame, weights: Weights | float, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id_col, score): the probability that each whole text is toxic."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if isinstance(weights, float) else Scorer(weights)
        for batch in text_batches(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            p = np.full(len(texts), weights) if scorer is None else scorer(texts)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p, pa.float64())], ["id", "score"])

    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
