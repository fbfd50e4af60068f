"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned
filters over short byte windows (an embedding of each byte, then a convolution) are
max-pooled over the chunk; a small layer turns the pooled values, and how full the chunk is,
into the chunk's evidence; the mean evidence over the document's chunks, weighted by their
bytes, becomes one probability.

Training is numpy with Adam on the driver, on a bounded sample of labelled rows
(``SAMPLE_DOCS`` documents, of each ``SAMPLE_CHUNKS`` chunks spread over the whole text);
the sample is that with the least hashes of id and text, so it is the same in every run.
Scoring covers every byte of every text.

Cases: a null or empty text is scored by an empty chunk. Labels that are null are not
learned from. With no labelled rows, or one class only, the score is that class's share
(0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, string_buffers, text_batches

CHUNK, OVERLAP, WIDTH = 256, 32, 8   # bytes
DEPTH, FILTERS, HIDDEN = 4, 24, 16
SAMPLE_DOCS, SAMPLE_CHUNKS = 6_000, 4
EPOCHS, LEAST_STEPS, ROWS, RATE = 10, 800, 64, 4e-3
SCORED_AT_ONCE = 1_024  # chunks
Weights = dict[str, np.ndarray]


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, owner) of the chunks of all texts; an empty text has one empty chunk."""
    length = np.diff(offsets)
    n = np.maximum(1, -(-(length - OVERLAP) // (CHUNK - OVERLAP)))
    owner = np.repeat(np.arange(len(length)), n)
    at = ranges(np.zeros(len(n), np.int64), n) * (CHUNK - OVERLAP)
    return offsets[:-1][owner] + at, np.minimum(CHUNK, length[owner] - at), owner


def windows(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte codes [chunk, CHUNK]: 1..256, 0 after the chunk's end."""
    padded = np.zeros(len(data) + CHUNK, np.int16)
    padded[:len(data)] = data
    padded[:len(data)] += 1
    out = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[start]
    out[np.arange(CHUNK) >= size[:, None]] = 0
    return out


def start_weights(seed: int = 3) -> Weights:
    r = np.random.default_rng(seed)
    return {k: v.astype(np.float32) for k, v in {
        "embed": r.normal(0, 0.5, (257, DEPTH)),
        "filter": r.normal(0, np.sqrt(2 / (WIDTH * DEPTH)), (WIDTH * DEPTH, FILTERS)),
        "shift": np.zeros(FILTERS),
        "hidden": r.normal(0, np.sqrt(2 / FILTERS), (FILTERS + 1, HIDDEN)),
        "hidden_shift": np.zeros(HIDDEN),
        "out": r.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), "out_shift": np.zeros(1)}.items()}


def _pooled(w: Weights, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pooled values and fullness, place of each maximum, embedded bytes) of the chunks."""
    embedded = w["embed"][codes]                                     # [n, CHUNK, DEPTH]
    n, places = len(codes), CHUNK - WIDTH + 1
    flat = np.ascontiguousarray(embedded).reshape(n, CHUNK * DEPTH)
    views = np.lib.stride_tricks.as_strided(
        flat, (n, places, WIDTH * DEPTH),
        (flat.strides[0], DEPTH * flat.itemsize, flat.itemsize), writeable=False)
    response = views.reshape(n * places, WIDTH * DEPTH) @ w["filter"]
    response = response.reshape(n, places, FILTERS)
    return response, flat, views


def _evidence(w: Weights, codes: np.ndarray) -> np.ndarray:
    response, _, _ = _pooled(w, codes)
    pooled = np.maximum(response.max(1) + w["shift"], 0)
    full = (codes > 0).mean(1, dtype=np.float32)[:, None]
    hidden = np.maximum(np.concatenate([pooled, full], 1) @ w["hidden"] + w["hidden_shift"], 0)
    return hidden @ w["out"] + w["out_shift"][0]


def _step(w: Weights, codes: np.ndarray, y: np.ndarray) -> Weights:
    """Gradients of the logistic loss over chunks that carry their document's label."""
    response, flat, views = _pooled(w, codes)
    n = len(codes)
    place = response.argmax(1)                                        # [n, FILTERS]
    pre = np.take_along_axis(response, place[:, None], 1)[:, 0] + w["shift"]
    full = (codes > 0).mean(1, dtype=np.float32)[:, None]
    joined = np.concatenate([np.maximum(pre, 0), full], 1)
    h_pre = joined @ w["hidden"] + w["hidden_shift"]
    h = np.maximum(h_pre, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ w["out"] + w["out_shift"][0], -30, 30)))
    d = ((p - y) / n).astype(np.float32)
    dh = d[:, None] * w["out"] * (h_pre > 0)
    dpre = (dh @ w["hidden"].T)[:, :FILTERS] * (pre > 0)
    taken = views[np.arange(n)[:, None], place]                       # [n, FILTERS, WIDTH*DEPTH]
    dfilter = np.einsum("nf,nfk->kf", dpre, taken)
    dtaken = dpre[:, :, None] * w["filter"].T                         # [n, FILTERS, WIDTH*DEPTH]
    which = codes[np.arange(n)[:, None, None], place[:, :, None] + np.arange(WIDTH)]
    dembed = np.zeros_like(w["embed"])
    np.add.at(dembed, which.ravel(), dtaken.reshape(-1, DEPTH))
    return {"embed": dembed, "filter": dfilter, "shift": dpre.sum(0), "hidden": joined.T @ dh,
            "hidden_shift": dh.sum(0), "out": h.T @ d, "out_shift": d.sum(keepdims=True)}


def train(codes: np.ndarray, labels: np.ndarray, seed: int = 5) -> Weights:
    w = start_weights()
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    r, t = np.random.default_rng(seed), 0
    steps = max(1, len(codes) // ROWS)
    epochs = max(EPOCHS, -(-LEAST_STEPS // steps))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for some in np.array_split(r.permutation(len(codes)), steps):
            t += 1
            for k, g in _step(w, codes[some], labels[some]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                w[k] = w[k] - rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(square[k] / (1 - 0.99 ** t)) + 1e-7)
    return {k: v.astype(np.float32) for k, v in w.items()}


def score_texts(w: Weights, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    start, size, owner = chunks(data, offsets)
    evidence = np.concatenate([
        _evidence(w, windows(*_part(data, start[k:k + SCORED_AT_ONCE], size[k:k + SCORED_AT_ONCE])))
        for k in range(0, len(start), SCORED_AT_ONCE)])
    weight = np.maximum(size, 1).astype(float)
    total = np.bincount(owner, weight * evidence) / np.bincount(owner, weight)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _part(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = int(start[0])
    return data[low:int((start + size).max())], start - low, size


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", may_learn=None) -> Weights | float:
    """Weights learned from the labelled rows for which ``may_learn`` (a column expression
    over ``id``) holds; the share of label 1 where there is only one class."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
              .filter("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").alias("y")))
    if may_learn is not None:
        marked = marked.filter(may_learn)
    # the ids come first: only the sampled texts reach the driver
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    docs = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("b"))
    n = F.octet_length("b")
    at = lambda k: F.floor((F.greatest(n - CHUNK, F.lit(0))) * k / max(1, SAMPLE_CHUNKS - 1)).cast("int")
    parts = F.array_distinct(F.transform(F.array(*[at(F.lit(k)) for k in range(SAMPLE_CHUNKS)]),
                                         lambda a: F.substring(F.col("b"), a + 1, F.lit(CHUNK))))
    rows = docs.join(F.broadcast(chosen), "id").select("id", "y", parts.alias("parts")).collect()
    rows.sort(key=lambda x: (x["id"], x["parts"]))
    pieces = [(p, r["y"]) for r in rows for p in r["parts"]]
    y = np.array([v for _, v in pieces], np.float32)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    size = np.array([len(p) for p, _ in pieces])
    codes = windows(np.frombuffer(b"".join(bytes(p) for p, _ in pieces), np.uint8),
                    np.cumsum(size) - size, size)
    return train(codes, y)


def score(docs: DataFrame, weights: Weights | float, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: id_col) and ``score``: the probability of label 1 of each whole text."""
    keep = keep or [id_col]
    text = text_col if text_col in keep else "__text"
    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text_col).alias(text))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text):
            data, offsets = string_buffers(batch.column(text))
            p = (np.full(batch.num_rows, weights) if isinstance(weights, float)
                 else score_texts(weights, data, offsets))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p, pa.float64())],
                                             [*keep, "score"])

    return rows.mapInArrow(run, docs.select(*keep).schema.add("score", "double"))
