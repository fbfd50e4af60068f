from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bankroll.llm import sentencepiece_np as S
from odd import odd_documents

PIECES = S.Pieces(S.read_model())


def best_score(text: str) -> float:
    """Highest summed score over all segmentations, the plain way."""
    score = {}
    for number, value in S._fields(S.read_model()):
        if number == 1:
            f = dict(S._fields(value))
            if f.get(3, S.NORMAL) == S.NORMAL:
                score[f[1].decode()] = float(np.frombuffer(f[2], "<f4")[0])
    text = S.SPACE + text.replace(" ", S.SPACE) if text else ""
    best = [0.0] + [float("-inf")] * len(text)
    for k in range(1, len(text) + 1):
        for size in range(1, min(16, k) + 1):
            s = score.get(text[k - size:k], PIECES.byte_score if size == 1 else float("-inf"))
            best[k] = max(best[k], best[k - size] + s)
    return best[-1]


def score_of(ids) -> float:
    table = {}
    for k, (number, value) in enumerate((n, v) for n, v in S._fields(S.read_model()) if n == 1):
        f = dict(S._fields(value))
        table[k] = float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0])
    total, run = 0.0, b""
    for k in ids:
        if k in PIECES.bytes:
            run += PIECES.bytes[k]
            try:
                run.decode()
                total, run = total + PIECES.byte_score, b""
            except UnicodeDecodeError:
                pass
        else:
            total += table[k]
    return total


def test_best_segmentation():
    for text in ["", " ", "hello world", "  two  spaces ", "日本語 ქართული 🎉 mixed", "a" * 70, "x\ty\nz", "naïve café",
                 "unbelievablyLongCompoundWordsInside camelCase"]:
        ids, counts = PIECES.encode([text])
        assert counts.tolist() == [len(ids)]
        assert score_of(ids.tolist()) == best_score(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40).filter(lambda t: S.SPACE not in t), max_size=5))
def test_round_trip(texts):
    ids, counts = PIECES.encode(texts)
    assert PIECES.decode(ids, counts) == texts


def test_batches_do_not_change_ids():
    texts = ["some words of a text", "", "some other words"]
    alone = [PIECES.encode([t])[0].tolist() for t in texts]
    ids, counts = PIECES.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == alone


def test_over_documents(lm, documents):
    docs = odd_documents(lm, documents)
    coded = S.encode(docs)
    rows = coded.collect()
    assert len(rows) == docs.count()
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
    back = sorted(((r.doc_id, r.text) for r in S.decode(coded).collect()), key=str)
    assert back == sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=str)


def test_space_mark_in_text(lm):
    df = lm.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert not S.encode(df).first().round_trip


def test_slices_and_cuts_do_not_change_ids(monkeypatch):
    for text in ("日本x語のtheater" * 9 + " abc " + "ß🎉漢" * 5, "ab" * 50 + "日本" * 30, "x" * 300):
        want = S.Pieces(S.read_model()).encode([text])[0].tolist()
        for long, cells in ((10**9, 3), (10**9, 40), (3, 3), (5, 100)):
            monkeypatch.setattr(S, "LONG", long)
            monkeypatch.setattr(S, "BLOCK_CELLS", cells)
            PIECES._forget()
            assert PIECES.encode([text])[0].tolist() == want
    PIECES._forget()


def test_three_million_characters_without_a_space():
    text = "日本語漢字仮名交じり文" * 272_728
    ids, counts = PIECES.encode([text])
    assert counts.tolist() == [len(ids)] and PIECES.decode(ids, counts) == [text]
    PIECES._forget()
