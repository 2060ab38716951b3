import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from verbatide.llm.packing import Packer, pack
from verbatide.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, texts, size):
    """Every id of every text in one piece, sequences gapless; returns the padding."""
    coder = Tokenizer.from_file(PATH)
    expected = sorted(coder.encode(t or "", add_special_tokens=False).ids + [1] for t in texts)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    found = []
    for (_, n), own in by_doc.items():
        whole = []
        for start, ids in sorted(own):
            assert start == len(whole)
            whole += ids
        assert n == len(whole)
        found.append(whole)
    assert sorted(found) == expected
    padding = 0
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
        if at & (at - 1):
            padding += size - at
    return padding


def test_all_documents(small_docs, small_texts):
    pieces = pack(small_docs.repartition(3), PATH, size=2048).collect()
    assert check(pieces, [t for _, t in small_texts], 2048) == 0


def test_tables_with_odd_rows(documents):
    texts = [None, "", " ", "a <|endoftext|> b", "你好 \U0001f600", "x y  z\n\n", "word " * 3000, "it's 12 o'clock"]
    docs = documents(list(enumerate(texts)))
    assert check(pack(docs, PATH, size=64, windows=2).collect(), texts, 64) == 0


def test_repeated_and_missing_ids(documents):
    docs = documents([(7, "same text"), (7, "same text"), (None, "no id"), (None, None)])
    rows = pack(docs, PATH, size=8).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 1), (0, 3), (7, 3), (7, 3)]
    assert pack(documents([]), PATH).collect() == []
    assert pack(documents([(1, None)]), PATH, end_id=None).collect() == []


def test_size_is_a_power_of_two(documents):
    with pytest.raises(ValueError):
        pack(documents([(1, "a")]), PATH, size=1000)


def test_best_fit_and_fullest():
    packer = Packer(8, 2, 0)
    for doc, n in enumerate((5, 6, 2, 4)):
        packer.add(doc, 0, b"\0\0\0\0" * n, n)
    # 2 ids fill the window of 6; 4 fit nowhere but into a new window beside that of 5.
    assert [[p[0] for p in pieces] for _, pieces in packer.done] == [[1, 2]]
    packer.add(4, 0, b"\0\0\0\0" * 7, 7)
    # 7 fit into neither: the fullest (5) is topped up, the other takes what is left.
    assert [[p[0] for p in pieces] for _, pieces in packer.done] == [[1, 2], [0, 4], [3, 4]]
    assert packer.windows == []
    packer.add(5, 0, b"\0\0\0\0" * 7, 7)
    packer.string_together()
    assert [sum(len(p[2]) // 4 for p in pieces) for _, pieces in packer.done[3:]] == [4, 2, 1]


def test_query(spark, small):
    rows = QUERIES["op12_packing"](spark, small)
    assert set(rows.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    coder = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in rows.limit(50).collect():
        ids = coder.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(ids))
