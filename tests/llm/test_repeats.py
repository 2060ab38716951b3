"""Removal of repeated bytes and words (op2, op5), against plain dictionaries."""

import hashlib
import random
import re

import numpy as np
import pytest

from verbatide.llm import automaton_dedup as A
from verbatide.llm import suffix_dedup as S
from verbatide.llm import windows as W


def gone(symbols, doc, first, window):
    marks = np.zeros(len(symbols) + 1, int)
    for i in range(len(symbols) - window + 1):
        if first.setdefault(tuple(symbols[i : i + window]), doc) < doc:
            marks[i] += 1
            marks[i + window] -= 1
    return np.cumsum(marks[:-1]) > 0


def plain_bytes(rows, window):
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        cut = gone(raw, doc, first, window)
        spans = int((np.diff(np.concatenate([[0], cut.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~cut])
        out[doc] = (len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def plain_words(rows, window):
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        cut = gone(words, doc, first, window)
        kept = " ".join(w for w, c in zip(words, cut) if not c)
        out[doc] = (len(words), int(cut.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def bytes_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def words_of(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


@pytest.fixture(scope="module")
def tangled():
    """Texts of few symbols with copies, overlaps, loops, long runs and multi-byte letters."""
    draw = random.Random(3)
    base = "".join(draw.choice("ab éß\n") for _ in range(900))
    rows = [(0, base), (1, None), (2, ""), (3, base[:49]), (4, "x" * 700), (5, "x" * 120)]
    for i in range(6, 40):
        a, b = draw.randrange(800), draw.randrange(800)
        parts = [base[a : a + draw.randrange(200)], "ab" * draw.randrange(60), base[b : b + 60]]
        draw.shuffle(parts)
        rows.append((i, draw.choice(["", "Q"]).join(parts)))
    return rows


def test_small_table(small_docs, small_texts):
    assert bytes_of(S.remove_repeats(small_docs)) == plain_bytes(small_texts, 50)
    assert words_of(A.remove_repeated_passages(small_docs)) == plain_words(small_texts, 50)


def test_tangled(documents, tangled):
    df = documents(tangled)
    assert bytes_of(S.remove_repeats(df)) == plain_bytes(tangled, 50)
    found = A.remove_repeated_passages(df, window=12, gram=4)
    assert words_of(found) == plain_words(tangled, 12)


def test_long_text_in_pieces(documents, monkeypatch):
    draw = random.Random(5)
    text = "".join(draw.choice("abcdefgh ") for _ in range(W.PIECE + 5000))
    rows = [(1, text), (2, "z" + text[W.PIECE - 200 :] + "z"), (3, "x" * (W.PIECE + 100)), (4, "x" * 90)]
    assert bytes_of(S.remove_repeats(documents(rows))) == plain_bytes(rows, 50)


def test_ids_that_repeat_or_lack(documents):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, "other " + text), (3, "abc")]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in S.remove_repeats(documents(rows)).collect())
    n = len(text)
    assert [g for g in got if g[0] < 3] == [(0, n, 0), (1, n, 0), (1, n, 0), (2, n, n)]
    # Of two texts with one id, one takes part and the other comes back whole.
    assert sorted(g[1] for g in got if g[0] == 3) == [3, n + 6]
    assert len(A.remove_repeated_passages(documents(rows)).collect()) == 6


def test_cut_keeps_columns(documents):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(1, text, "en", "s", 5), (2, text, "en", "s", 5), (3, text + "é tail", "de", "t", 7), (4, None), (5, "")]
    df = documents(rows)
    cut = S.cut_repeats(df)
    assert cut.columns == df.columns
    assert {r.doc_id: (r.text, r.lang, r.score) for r in cut.collect()} == {
        1: (text, "en", "clash"),
        3: ("é tail", "de", "clash"),
        4: (None, None, "clash"),
        5: ("", None, "clash"),
    }


def test_empty_table(documents):
    assert S.remove_repeats(documents([])).collect() == []
    assert A.remove_repeated_passages(documents([])).collect() == []


def test_automaton_knows_smallest_documents():
    draw = random.Random(1)
    texts = [[draw.choice("abc") for _ in range(draw.randrange(40))] for _ in range(30)]
    automaton = A.SuffixAutomaton()
    for doc, words in enumerate(texts):
        automaton.add(words, doc)
    for doc, words in enumerate(texts):
        for end, hit in enumerate(automaton.matches(words, doc, 4), 1):
            tail = "".join(words[end - 4 : end])
            want = end >= 4 and any(tail in "".join(texts[d]) for d in range(doc))
            assert hit == want


def thue_morse(letters: bytes) -> str:
    word = "".join(letters[bin(i).count("1") % 2 : bin(i).count("1") % 2 + 1].decode() for i in range(1024))
    return word


def test_long_words_of_one_polynomial(documents):
    """Words that a polynomial modulo 2 ** 64 cannot tell apart, whatever its base."""
    from verbatide.llm.automaton_dedup import remove_repeated_passages
    from verbatide.llm.decontaminate import contaminated

    same = " ".join(f"w{i}" for i in range(49))
    docs = documents([(1, f"{same} {thue_morse(b'ab')}"), (2, f"{same} {thue_morse(b'ba')}")])
    for parts in (1, 2):
        found = remove_repeated_passages(docs.coalesce(parts) if parts == 1 else docs, window=50)
        assert {r.doc_id: r.n_removed for r in found.collect()} == {1: 0, 2: 0}
    items = docs.filter("doc_id = 1").selectExpr("doc_id as item_id", f"'{thue_morse(b'ba')} ' || repeat('{thue_morse(b'ab')} ', 4) as text")
    texts = documents([(5, f"{thue_morse(b'ab')} " + f"{thue_morse(b'ba')} " * 4)])
    assert contaminated(texts, items, least=5, coverage=0.5).collect() == []
