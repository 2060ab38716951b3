import hashlib
import random
import zlib

import numpy as np
import pytest

from verbatide.llm.periodic_runs import Extensions, collapse_runs, find_runs
from verbatide.llm.queries import QUERIES


def plain_runs(words, least=12):
    """All runs by comparing every word with every later one."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_words(draw):
    words = [f"w{draw.randrange(draw.choice([1, 2, 3, 40]))}" for _ in range(draw.choice([0, 1, 11, 12, 60, 150]))]
    for _ in range(draw.randrange(3)):
        unit = [f"v{draw.randrange(4)}" for _ in range(draw.randrange(1, 20))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = (unit * 12)[: draw.randrange(1, 12 * len(unit))]
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_many_texts(documents, least):
    draw = random.Random(least)
    texts = [made_words(draw) for _ in range(60)]
    docs = documents([(i, " ".join(words)) for i, words in enumerate(texts)])
    for row in collapse_runs(docs, least).collect():
        words = texts[row.doc_id]
        runs = [tuple(r) for r in row.runs]
        assert runs == plain_runs(words, least)
        assert row.collapsed == plain_collapse(words, runs)


def test_extensions_of_all_pairs():
    draw = np.random.default_rng(3)
    symbols = np.concatenate([draw.integers(0, 2, 70), [7], np.tile([0, 1, 1], 30), [8]])
    held = Extensions(symbols)
    n = len(symbols)
    a, b = np.triu_indices(n, 1)
    common = held.forward(a, b)
    for i, j, c in zip(a.tolist(), b.tolist(), common.tolist()):
        k = 0
        while j + k < n and symbols[i + k] == symbols[j + k]:
            k += 1
        assert c == k


def test_only_sampled_suffixes_are_sorted():
    held = Extensions(np.append(np.zeros(1300, np.int64), 1))
    assert len(held.rank) == 4 * 100 + 1


def test_long_repetitive_texts(documents):
    docs = documents([(1, "a " * 20000), (2, "a b c " * 9000 + "d"), (3, "x" * 300_000)])
    rows = {r.doc_id: r for r in collapse_runs(docs).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 20000, 1)] and rows[1].collapsed == "a"
    assert [tuple(r) for r in rows[2].runs] == [(0, 27000, 3)] and rows[2].collapsed == "a b c d"
    assert rows[3].runs == [] and len(rows[3].collapsed) == 300_000


def test_odd_rows(documents):
    docs = documents([(1, None), (2, ""), (3, " \t\n "), (None, "a " * 12), (4, "b " * 12), (4, "b " * 12)])
    rows = sorted(((r.doc_id or 0, len(r.runs), r.collapsed) for r in collapse_runs(docs).collect()))
    assert rows == [(0, 1, "a"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 1, "b"), (4, 1, "b")]
    assert collapse_runs(documents([])).collect() == []
    assert [len(c) for c in find_runs(np.zeros(0, np.int64), np.zeros(0, np.int64), 12)] == [0] * 4


def test_query(spark, small, small_texts):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    assert len(rows) == len(small_texts)
    for doc_id, text in small_texts:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, row = plain_runs(words), rows[doc_id]
        assert row.n_runs == len(runs)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == (s, n, q)
        assert row.exponent_milli == (None if n is None else 1000 * n // q)
