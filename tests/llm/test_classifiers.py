from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankroll.llm import quality_cnn, toxicity
from bankroll.llm.queries import QUERIES, _remainder
from odd import odd_documents

SF = "/root/testdata/sf0.1"


def scored(df):
    return sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 8)) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    words = ["the", "of", "river", "stone", "green", "walks", "under", "bright", "morning", "table"]
    line = lambda n: " ".join(r.choices(words, k=n))
    return [line(r.randrange(10, 120)) for _ in range(150)]


def test_network_learns_noise_marks(texts):
    noisy = [" ".join(w + "***" for w in t.split()) for t in texts]
    raw = [t.encode() for t in texts + noisy]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(t) for t in raw])]
    y = np.r_[np.ones(150), np.zeros(150)].astype(np.float32)
    start, size, owner = quality_cnn.chunks(data, offsets)
    w = quality_cnn.train(quality_cnn.windows(data, start, size), y[owner])
    p = quality_cnn.score_texts(w, data, offsets)
    assert ((p >= 0.7) == (y == 1)).mean() > 0.97
    # a text's score does not depend on the texts around it
    one = quality_cnn.score_texts(w, np.frombuffer(raw[7], np.uint8), np.array([0, len(raw[7])]))
    assert one[0] == pytest.approx(p[7], abs=1e-5)


def test_network_gradients():
    r = np.random.default_rng(0)
    codes, y = r.integers(1, 9, (6, quality_cnn.CHUNK)).astype(np.int16), np.array([0, 1, 1, 0, 1, 0], np.float32)
    w = {k: v.astype(np.float64) for k, v in quality_cnn.start_weights().items()}

    def loss(w):
        z = quality_cnn._evidence(w, codes)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g = quality_cnn._step(w, codes, y)
    for k, at in (("embed", (3, 1)), ("filter", (5, 2)), ("hidden", (1, 3)), ("out", (4,)), ("shift", (2,))):
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-4)


def test_chunks_cover_every_byte():
    lengths = np.array([0, 1, 31, 256, 257, 480, 481, 5000])
    offsets = np.r_[0, np.cumsum(lengths)]
    start, size, owner = quality_cnn.chunks(np.zeros(offsets[-1], np.uint8), offsets)
    for k, n in enumerate(lengths):
        seen = np.zeros(n, bool)
        for a, s in zip(start[owner == k], size[owner == k]):
            seen[a - offsets[k]:a - offsets[k] + s] = True
        assert seen.all() and (owner == k).any()


def test_toxic_words_and_misspellings(texts):
    r = random.Random(2)
    bad = []
    for t in texts:
        w = t.split()
        w.insert(r.randrange(len(w)), r.choice(["blockhead", "blockheads", "numbskull", "numbskulls"]))
        bad.append(w)
    docs = [t.split() for t in texts] + bad
    w = toxicity.train(docs, np.r_[np.zeros(150, int), np.ones(150, int)])
    score = toxicity.Scorer(w)
    p = score([" ".join(d) for d in docs])
    assert ((p >= 0.5) == np.r_[np.zeros(150, bool), np.ones(150, bool)]).mean() > 0.97
    clean = texts[3]
    assert score([clean + " blockheadz"])[0] > 0.5 > score([clean])[0]  # never seen in training
    long = " ".join(texts * 5)
    assert score([long + " numbskull " + long])[0] > 0.5 > score([long])[0]


def test_passages_cover_every_word():
    n = np.array([0, 1, 8, 16, 17, 100])
    first, size, owner = toxicity.passages(n)
    base = np.cumsum(n) - n
    for k in range(len(n)):
        seen = set()
        for a, s in zip(first[owner == k], size[owner == k]):
            seen |= set(range(a - base[k], a - base[k] + s))
        assert seen == set(range(n[k])) and (owner == k).any()


# toxic words of the small tables' other languages occur a few times each among the labelled rows
@pytest.mark.parametrize("name, label, by, held, cut, least", [
    ("op4_quality", "quality", 4, 2, 0.7, (0.95, 0.98)), ("op8_toxicity", "toxic", 5, 0, 0.5, (0.98, 0.7))])
def test_held_out_accuracy(lm, name, label, by, held, cut, least):
    got = QUERIES[name](lm, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(lm.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").withColumn(
        "again", _remainder("doc_id", by) == held).collect()
    assert len(rows) == lm.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == r.again and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
    for y in (0, 1):
        own = [r.predicted == y for r in rows if r.held_out and r[label] == y]
        assert sum(own) / len(own) >= least[y], (y, sum(own), len(own))


@pytest.mark.parametrize("module", [quality_cnn, toxicity])
def test_odd_rows_and_few_labels(lm, module):
    docs = odd_documents(lm)
    none = lm.createDataFrame([], "doc_id long, quality int, toxic int")
    w = module.fit(docs, none)
    assert w == 0.5 and module.score(docs, w).count() == docs.count()
    one = lm.createDataFrame([(-3, 1, 1), (None, 0, 0), (-4, None, None)], none.schema)
    assert module.fit(docs, one) == 1.0
    both = lm.createDataFrame([(-3, 1, 1), (-5, 0, 0), (-1, 1, 1), (-2, 0, 0)], none.schema)
    w = module.fit(docs, both)
    rows = module.score(docs, w).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.score(docs.limit(0), w).count() == 0
    # scores do not depend on how rows are dealt to batches
    assert scored(module.score(docs.repartition(3), w)) == scored(module.score(docs.coalesce(1), w))


def test_labels_outside_the_rule_are_not_read(lm):
    docs = lm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = lm.read.parquet("/root/testdata/sf0.001/labels.parquet")
    may = _remainder("id", 4) != 2
    turned = labels.withColumn("quality", F.when(_remainder("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_cnn.fit(docs, x, may_learn=may) for x in (labels, turned))
    assert all(np.array_equal(a[k], b[k]) for k in a)
