from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from bankroll.llm import token_tree as T
from odd import odd_documents

COUNTER = T.Counter(T.read_ranks())


def tree_of(text: str) -> T.Tree:
    parts = COUNTER.cut(text)
    import numpy as np

    return T.Tree(text, np.array([len(p) for p in parts], np.int32), COUNTER.counts(parts), COUNTER)


def count(text: str) -> int:
    return len(COUNTER.encoding.encode_ordinary(text))


def apply(text, edits):
    for start, end, new in edits:
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        text = text[:start] + new + text[end:]
    return text


def check(text, edits):
    tree = tree_of(text)
    assert tree.n_tokens == count(text)
    for k, (start, end, new) in enumerate(edits):
        tree.edit(start, end, new)
        want = apply(text, edits[:k + 1])
        got, chars, tokens = tree.state()
        assert got == want
        assert chars.tolist() == [len(p) for p in COUNTER.cut(want)]
        assert tree.n_tokens == tokens.sum() == count(want)


ALPHABET = "ab'srtlve 1 \n\t  .é日🎉"


@settings(max_examples=250, deadline=None)
@given(st.text(ALPHABET, max_size=60), st.lists(st.tuples(st.integers(-2, 70), st.integers(-2, 70),
                                                          st.text(ALPHABET, max_size=8)), max_size=5))
def test_any_edits(text, edits):
    check(text, edits)


def test_many_edits_of_a_long_text():
    r = random.Random(4)
    text = " ".join("".join(r.choices("abcde'", k=r.randrange(1, 9))) for _ in range(6000))
    edits = [(a := r.randrange(len(text)), a + r.randrange(0, 30), "".join(r.choices(ALPHABET, k=r.randrange(0, 20))))
             for _ in range(40)]
    check(text, edits)
    tree = tree_of(text)
    for e in edits:
        tree.edit(*e)
    assert tree.encoded < 40 * 60  # regions, not the text


def test_growth_builds_anew():
    check("a b c", [(2, 3, "word " * 3000), (100, 14_000, ""), (0, 0, "start ")])


def test_over_documents(lm, documents):
    docs = odd_documents(lm, documents)
    state = T.build(docs)
    edits = lm.createDataFrame([(-3, 2, 0, 3, "two"), (-3, 1, 0, 0, "begin "), (-1, 1, 5, 9, "from nothing"),
                                (-2, 1, None, None, None), (12345, 1, 0, 1, "x")],
                               "doc_id long, seq int, start int, end int, replacement string")
    rows = T.apply_edits(T.with_edits(state, edits)).collect()
    assert len(rows) == docs.count()
    source = {(r.doc_id, r.text or "") for r in docs.collect()}
    for r in rows:
        assert r.n_tokens == count(r.text) == sum(r.leaf_tokens)
        if r.n_edits == 0:
            assert (r.id, r.text) in source and r.n_encoded == 0 and r.n_tokens_before == r.n_tokens
    changed = sorted((r.id, r.text, r.n_edits) for r in rows if r.n_edits)
    assert changed == [(-3, "twoin one two", 2), (-3, "twoin one two", 2), (-2, "", 1), (-1, "from nothing", 1)]
    assert T.build(docs.limit(0)).count() == 0


def test_query_counts(lm):
    from bankroll.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text, r.source) for r in lm.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op9_tokencounts"](lm, sf).collect():
        text, source = texts[r.doc_id]
        assert r.n_tokens_before == count(text) and r.n_edits == 2
        a, b = int(len(text) * 0.3), int(len(text) * 0.7)
        assert r.n_tokens == count(apply(text, [(a, a + 12, text[:24]), (b, b, " " + source)]))
