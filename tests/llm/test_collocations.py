from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bankroll.llm import collocations as C
from brute import LOWER
from odd import odd_documents

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def brute(rows, least=30, top=2000):
    """Plain counts of all phrases of one to four words, then the rules one by one."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    count[lang][tuple(words[k:k + size])] += 1
    out = []
    for lang, f in count.items():
        many = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in many.items():
            best, _, l, r = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            longer = max((b for h, b in many.items() if len(h) > len(g) and
                          any(h[k:k + len(g)] == g for k in range(len(h) - len(g) + 1))), default=None)
            if longer is None or 100 * longer < 80 * a:
                rows.append((lang, " ".join(g), a, l, r, total[lang], best))
        rows.sort(key=lambda x: (-x[6], -x[2], x[1].encode("utf-8")))
        out += [(x[0], k, *x[1:]) for k, x in enumerate(rows[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(lm, seed=0):
    """Texts with repeated passages, very common words and pairs, long words and pieces."""
    rng = np.random.default_rng(seed)
    words = ["a", "A", "b", "c", "dd", "é", "日本", "<x>", "x" * 50]
    passages = [" ".join(f"w{k}" for k in range(n, n + 9)) for n in (0, 5, 30)]
    rows = []
    for k in range(300):
        parts = [str(rng.choice(words)) for _ in range(int(rng.integers(0, 30)))]
        for at in rng.integers(0, len(parts) + 1, 2):
            parts.insert(int(at), str(rng.choice(passages + [", ", ". ", "\n", "\t", "the the the the the", "!x"])))
        rows.append((k, " ".join(parts), [None, "en", "und", "de"][int(rng.integers(0, 4))]))
    return lm.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("least,top", [(2, 10_000), (30, 2000), (5, 7)])
def test_equals_plain_counts(lm, least, top):
    docs = made(lm)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(C.collocations(docs, least=least, top=top)) == brute(rows, least, top)


def test_over_documents(lm, documents):
    docs = odd_documents(lm, documents)
    want = brute([(r.lang, r.text) for r in docs.collect()])
    assert want and got(C.collocations(docs)) == want


def test_other_ways(lm, monkeypatch):
    """Small slices, paths of short rows, all words hot, hashes instead of numbers: the same."""
    docs = made(lm, 1)
    want = brute([(r.lang, r.text) for r in docs.collect()], 3, 500)
    with monkeypatch.context() as m:
        m.setattr(C, "PATH_EDGES", 2)
        m.setattr(C, "HOT_SHARE", 0.0)
        m.setattr(C, "RANK_ROWS", 50)
        assert got(C.collocations(docs, least=3, top=500)) == want
        m.setattr(C, "VOCABULARY", 0)
        assert got(C.collocations(docs, least=3, top=500)) == want


def test_slices(monkeypatch):
    """The words of a batch do not depend on where its slices are cut."""
    texts = ["one two, three", "", "four" * 30, " five\tsix.", "seven", "eight 日本 nine!ten"] * 3
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]

    def words(size):
        monkeypatch.setattr(C, "SLICE", size)
        return [(data[a:b].tobytes(), int(t), bool(n)) for s, e, x, w in C._tokens(data, offsets)
                for a, b, t, n in zip(s, e, x, w)]

    whole = words(1 << 20)
    want = [(w.encode(), k, j == 0) for k, t in enumerate(texts) for p in PIECE.split(t) for j, w in enumerate(WORD.findall(p))]
    assert whole == want
    for size in (1, 2, 3, 7, 50):
        assert words(size) == want


def test_paths_are_compact(lm):
    """A passage that always occurs whole is one path; its inner nodes are not kept."""
    passage = " ".join(f"w{k}" for k in range(40))
    docs = lm.createDataFrame([(k, f"{passage}. w3 w4 w5 other{k % 2}", "en") for k in range(40)], "doc_id long, text string, lang string")
    graph = C.build(docs)
    rows = graph.paths.collect()
    # w3 w4 w5 also occurs elsewhere: its node is not unary
    assert sorted(len(r.next) for r in rows) == [3, 34]
    assert graph.nodes.count() < 10
    f = {r.code: r.word for r in graph.words.collect()}
    counts = {tuple(f[x] for x in r[:4] if x): r.f for r in graph.counts().collect()}
    assert counts[("w3", "w4", "w5")] == 80 and counts[("w10", "w11", "w12")] == 40 and counts[("w38", "w39")] == 40


def test_empty(lm):
    empty = lm.createDataFrame([], "doc_id long, text string, lang string")
    assert C.collocations(empty).collect() == []
    few = lm.createDataFrame([(1, None, None, 5), (2, "a b", "en", 6)], "doc_id long, text string, lang string, rank long")
    assert C.collocations(few).collect() == []
