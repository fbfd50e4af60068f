from __future__ import annotations

import re

import brute
import corpus_pipeline as C
from bankroll.llm import decontam, quality_cnn, secret_scan, sentencepiece_np
from bankroll.llm.queries import quality_weights
from test_secrets import base_spans

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(lm):
    docs = lm.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "pieces"]
    for _, stage in C.STAGES[:-1]:
        out = stage(lm, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_run_equals_plain_steps(lm):
    """The same documents, step by step in plain Python (the network's own scores and the
    operators' exact checks stand for themselves in their own tests)."""
    docs = lm.read.parquet(f"{SF}/documents.parquet")
    score = {r.doc_id: r.score for r in quality_cnn.score(docs, quality_weights(lm, docs, SF)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if score[r.doc_id] >= 0.7]
    rows = [(i, t) for (i, t), (_, n, c, kept) in zip(rows, brute.near_duplicates(rows)) if kept or not n]
    items = [r.text for r in lm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    own = [brute.shingles(t) for t in items]

    def dirty(text):
        words = brute.WORD.findall(text.translate(brute.LOWER))
        every = brute.shingles(text)
        for t, s in zip(items, own):
            if 2 * len(s & every) < len(s):
                continue
            n = len(brute.WORD.findall(t))
            for size in range(n - decontam.SLACK, n + decontam.SLACK + 1):
                for at in range(max(1, len(words) - size + 1)):
                    w = brute.shingles(" ".join(words[at:at + size]))
                    if 100 * len(s & w) >= 75 * len(s | w):
                        return True
        return False

    rows = {i: t for i, t in rows if not dirty(t or "")}
    got = C.run(lm, SF)
    assert {r.doc_id for r in got.collect()} == set(rows)
    back = {r.doc_id: r.text for r in sentencepiece_np.decode(got).collect()}
    for i, text in rows.items():
        parts = [re.escape(p) for p in back[i].split("[SECRET]")]
        assert re.fullmatch(".*".join(parts), text, re.S)
        if "[SECRET]" not in back[i]:
            assert back[i] == text
        else:
            assert base_spans(text) or secret_scan.ADDED_KINDS


def test_registered():
    import __spark_entry__ as E

    names = list(E.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
