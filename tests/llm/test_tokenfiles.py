from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bankroll.llm import token_files as T
from odd import odd_documents

WHOLE = Tokenizer.from_file(T.TOKENIZER)


def words() -> T.WordIds:
    with open(T.TOKENIZER, "rb") as f:
        return T.WordIds(f.read())


WORDS = words()


def plain(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


def ids(coder, texts):
    return [np.frombuffer(b, coder.code).tolist() for b in coder.encode(texts)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300))
def test_select_gives_the_numbers(values):
    values = np.sort(np.array(values, np.uint64))
    ef = T.EliasFano.of(values)
    for e in (ef, T.EliasFano.from_bytes(ef.to_bytes())):
        assert np.array_equal(e.select(np.arange(len(values))), values)
    assert ef.nbytes == len(ef.to_bytes())


def test_select_far_apart_and_dense():
    for values in (np.array([0, 1, (1 << 64) - 1], np.uint64), np.zeros(5000, np.uint64),
                   np.arange(100_000, dtype=np.uint64), np.r_[np.arange(3000), 10**9 + np.arange(3000)].astype(np.uint64)):
        ef = T.EliasFano.from_bytes(T.EliasFano.of(values).to_bytes())
        some = np.array([len(values) - 1, 0, len(values) // 2])
        assert np.array_equal(ef.select(some), values[some])
    # bounds of documents of about 400 ids: near 2 + log2(400) bits each, the counts before blocks included
    ends = np.cumsum(np.random.default_rng(1).integers(1, 800, 20_000))
    assert 8 * T.EliasFano.of(ends).nbytes < 11.5 * len(ends)


def test_every_plain_letter():
    """Each letter that is handled outside the library's pipeline, alone and inside words."""
    letters = [c for c in map(chr, range(0x250)) if T._PLAIN.fullmatch(c)]
    assert len(letters) > 440 and "İ" not in letters and "×" not in letters
    texts = [f"{c} a{c}b x{c}{c}, {c}." for c in letters]
    assert ids(words(), texts) == [plain(t) for t in texts]


ALPHABET = st.sampled_from(list("ab  \n\t.,;'s09ÉßİΣσ日́Å\x0b\xa0<|>_-") + ["<|endoftext|>", "word", "'re", "..."])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), max_size=4))
def test_ids_are_the_librarys(texts):
    assert ids(WORDS, texts) == [plain(t) for t in texts]


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "KNOWN_BYTES", 20 * T.WORD_BYTES)
    coder = words()
    rng = np.random.default_rng(3)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice(list("abcdé.,7"), 6)) for _ in range(30)) for _ in range(3)]
        assert ids(coder, texts) == [plain(t) for t in texts]
    assert len(coder.known) + len(coder.before) < 400


def test_a_word_is_looked_up_once_a_batch():
    """However often it occurs, and also with punctuation at its end: words cost, occurrences hardly do."""
    class Counting(dict):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    coder, piped = words(), []
    coder.known, pipeline = Counting(), coder._pipeline
    coder._pipeline = lambda some: piped.extend(some) or pipeline(some)
    texts = ["to be or not to be." + " be" * 5000, *(f"{a}{b}x### {a}{b}y, ({a})" for a in "abcde" for b in "fghij")]
    assert ids(coder, texts) == [plain(t) for t in texts]
    assert Counting.asked < 200
    assert not [w for w in piped if w.endswith("x###")]


def test_texts_are_parted_as_the_library_does():
    """Bounds of texts are bounds of words; A-Z become small only where no mark joins them and no
    special token is made; marks that close words of other letters; nulls and slices."""
    texts = [None, "end.", ".Start", "", "a", "b.", " ", "\t.\n", "J\u030c A\u030a J\u030c. x", "<|ENDOFTEXT|>", "A<|endoftext|>B. C",
             "<|endoftext|>. THE<| THE", "日本THE. THE", "CAFÉ. Café! ÆON: ×. A÷. Ⱥ. Ⱦz! İ. i", "It's. IT'S 'TIS, 'twas.", "x.. y.,.", "R2. 2. a2.",
             "\u00a0A. B\u00a0.", "K. K.", "A.\rB", "word<|. <| |>"]
    assert ids(words(), texts) == [plain(t or "") for t in texts]
    column = T.pa.array(texts, T.pa.string())
    for a in range(len(texts)):
        assert ids(words(), column.slice(a, 3)) == [plain(t or "") for t in texts[a:a + 3]]
    assert words().encode([]) == [] and words().encode([None, ""]) == [b"", b""]


def expected(rows):
    """(doc_id, n, crc) of each row."""
    out = []
    for i, t in rows:
        x = np.array(plain(t or "") + [T.END_ID], "<u4")
        out.append((i, len(x), zlib.crc32(x.tobytes())))
    return out


def check(got, rows):
    order = lambda r: (r[0] is not None, r[0] if r[0] is not None else 0)
    got = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert [g[1] for g in got] == np.r_[0, np.cumsum([g[2] for g in got])[:-1]].tolist()  # no gaps
    assert got == sorted(got, key=order)  # ascending ids
    assert sorted(((g[0], g[2], g[3]) for g in got), key=str) == sorted(expected(rows), key=str)


def test_over_documents(lm, documents, monkeypatch):
    """Small segments and ranges, so that every file level is met."""
    monkeypatch.setattr(T, "LEAST_RANGE_BYTES", 50_000)
    docs = odd_documents(lm, documents)
    got = T.write_and_read(docs).select("doc_id", "start", "n_tokens", "ids_crc32")
    check(got.collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_ids_come_back(lm, scratch, documents):
    T.write_ids(documents, scratch + "/x")
    back = T.read_ids(lm, scratch + "/x", with_ids=True)
    want = {r.doc_id: plain(r.text or "") + [T.END_ID] for r in documents.collect()}
    rows = back.collect()
    assert {r.id: r.token_ids for r in rows} == want
    assert sorted(r.doc_no for r in rows) == list(range(len(want)))


def test_small_segments(lm):
    """Segments end by ids and by documents; the encoder is called as Spark calls it."""
    pa = T.pa
    with open(T.TOKENIZER, "rb") as f:
        data = f.read()

    class Task:
        @staticmethod
        def partitionId():
            return 3

    old = T.SEGMENT_IDS, T.SEGMENT_DOCS, T.TaskContext
    try:
        T.SEGMENT_IDS, T.SEGMENT_DOCS, T.TaskContext = 40, 4, type("C", (), {"get": staticmethod(lambda: Task)})
        texts = ["a b c", "", "word " * 100, *["x"] * 11]
        names = [None, None, *range(-5, 7)]
        batch = pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts)], ["id", "text"])
        blobs = [b.column(0)[0].as_py() for b in T._encoder(data, 2)([batch])]
    finally:
        T.SEGMENT_IDS, T.SEGMENT_DOCS, T.TaskContext = old
    read = list(T.segments(b"".join(b + b"\n" for b in blobs)))
    assert [s.number for s in read] == list(range(len(read))) and all(s.range == 3 for s in read)
    assert len(read) >= 4 and sum((s.names() for s in read), []) == names
    got = [s.ids[a:b].tolist() for s in read for k in [np.arange(s.docs)] for a, b in zip(s.starts(k), s.ends(k))]
    assert got == [plain(t) + [2] for t in texts]
    with pytest.raises(ValueError):
        list(T.segments(blobs[0]))


def test_text_ids_empty_table_and_clashing_columns(lm):
    rows = [("b", "two words", 1, 1), ("a", None, 2, 2), (None, "x", 3, 3), ("é", "y", 4, 4), ("a", "z", 5, 5)]
    docs = lm.createDataFrame(rows, "doc_id string, text string, start long, id long")
    got = [tuple(r) for r in T.write_and_read(docs).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, "a", "a", "b", "é"]
    assert sorted(r[3] for r in got) == sorted(n for _, n, _ in expected([(r[0], r[1]) for r in rows]))
    assert T.write_and_read(docs.limit(0)).collect() == []


def test_hot_id(lm):
    """A third of all rows under one id: dealt to several ranges, all written."""
    docs = lm.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "concat('text ', id) as text")
    got = T.write_and_read(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])
