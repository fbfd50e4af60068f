from __future__ import annotations

import random
from collections import Counter

import numpy as np

import brute
from bankroll.llm import neardup, textnp
from bankroll.llm.components import connected_components
from odd import odd_documents


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())


def test_equals_brute_force(lm, documents):
    docs = odd_documents(lm, documents)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == Counter(brute.near_duplicates(rows))


def test_families_of_copies_and_shared_passages(lm):
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    passage = [word() for _ in range(60)]
    rows, n = [], 0
    base = [word() for _ in range(120)]
    for _ in range(150):  # near copies of one text
        copy = list(base)
        for _ in range(r.randrange(0, 5)):
            copy[r.randrange(len(copy))] = word()
        rows.append((n := n + 1, " ".join(copy)))
    for _ in range(150):  # half shared passage, half own words
        own = [word() for _ in range(r.randrange(10, 60))]
        rows.append((n := n + 1, " ".join(passage + own)))
    rows += [(n + k, " ".join(base)) for k in range(1, 80)]
    df = lm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == Counter(brute.near_duplicates(rows))


def test_blocks_of_large_groups(lm, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP_ROWS", 7)
    r = random.Random(9)
    base = [f"w{r.randrange(10**6)}" for _ in range(80)]
    rows = []
    for k in range(60):
        copy = list(base)
        for j in range(k % 6):
            copy[(13 * j + k) % 80] = f"e{k}x{j}"
        rows.append((k, " ".join(copy)))
    df = lm.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == Counter(brute.near_duplicates(rows))


def test_keep_one_of_each_group(lm):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(3, text, 1), (2, text + " x", 2), (2, text + " x", 3), (9, "other words stand here alone", 4),
            (None, "other words stand here alone", 5), (7, None, 6), (7, "", 7)]
    df = lm.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(2, text + " x"), (9, "other words stand here alone"), (7, None), (7, "")], key=str)


def test_keep_one_without_ids_and_with_repeated_ids(lm):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(None, text(k)) for k in range(6)] + [(None, text(0) + " x"), (None, text(1))]
    rows += [(5, text(k)) for k in range(10, 14)] + [(5, text(10) + " x"), (6, text(20)), (6, text(20) + " x"), (6, text(21))]
    got = Counter((r.doc_id, r.text.split()[0].split("x")[0])
                  for r in neardup.keep_one(lm.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(None, f"w{k}") for k in range(6)] + [(5, f"w{k}") for k in range(10, 14)] + [(6, "w20"), (6, "w21")]
    assert got == Counter(want)


def test_empty_table(lm):
    df = lm.createDataFrame([], "doc_id long, text string")
    assert found(df) == Counter()
    assert neardup.keep_one(df).count() == 0


def test_words_and_shingles():
    texts = ["A b\tC", "", "longerthaneightbytes x longerthaneightbytesY", "  lead"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    start, end, first = textnp.words(data, offsets)
    got = [bytes(data[a:b]) for a, b in zip(start, end)]
    assert got == [w.encode() for t in texts for w in t.split()]
    h = textnp.hash_words(data, start, end)
    assert len(set(h.tolist())) == len(set(w.lower() for w in got))
    assert first.tolist() == [0, 3, 3, 6, 7]


def test_components_of_a_long_path(lm):
    n = 300
    edges = lm.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(n + 1)}, 1000: 1000, 1001: 1000}
