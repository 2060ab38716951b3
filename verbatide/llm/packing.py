"""Token sequences of bounded length, packed online in bounded space.

Each task encodes its documents and keeps a fixed number of windows open. A document's
full windows are emitted at once; what is left of it goes, whole, into the open window
it fills best. If none has room and no further one may be opened, the fullest is topped
up with the document's next ids and emitted, and the others are tried anew. Windows
still open at a task's end are merged, those of a fixed number of tasks together: their
pieces are packed again, longest first, and what stays open is strung together. The last
window of such a group is cut into powers of two, which need no padding.

So whatever a task emits is full, and memory holds the open windows and a block of texts.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from verbatide.storage import scratch_path

# Characters encoded at once, ids that a batch of rows holds, and pre-tokens remembered.
TEXT_BLOCK, ID_BLOCK, REMEMBERED = 1 << 21, 1 << 21, 1 << 18
# Tasks whose open windows are merged together.
MERGED_TASKS = 16
# Merged sequences are numbered from here, a task's own from its number times 2 ** 32.
MERGED = 1 << 62

# Beyond these characters, notions of letters and white space may differ between libraries.
_UNSURE = re.compile("[^\t\n\r -~\xa0-ſ‐-‟…€]").search
# How byte-level BPE of this family divides a text, with the letters and
# numbers among the characters above.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
_split = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+"
).findall
# Fixed value: byte-level vocabularies spell visible Latin-1 bytes as themselves and the
# others, in order, as the characters from U+0100 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELLED = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - _VISIBLE))}
# Texts by which a tokenizer is tried before its pre-tokens are taken apart here.
_TRIAL = "It's they'll  12 o'clock,\n\n a\tb \x7f  \xe9\xfc\u017f \xa0\xbd? \u201cend\u201d\u2026 \u20ac5 "
_loaded: dict = {}


class Pieces(dict):
    """Pre-tokens to ids, learned when first asked for; ``older`` are those of before."""

    def __init__(self, tokenizer, older=()):
        super().__init__()
        self.tokenize, self.older = tokenizer.model.tokenize, older

    def __missing__(self, token):
        if token in self.older:
            ids = self.older.pop(token)
        else:
            if token.isascii() and token.isprintable():
                spelled = token.replace(" ", _SPELLED[32])
            else:
                spelled = token.encode().decode("latin-1").translate(_SPELLED)
            found = [piece.id for piece in self.tokenize(spelled)]
            ids = struct.pack(f"<{len(found)}I", *found)
        self[token] = ids
        return ids


class Encoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit numbers.

    A byte-level tokenizer never merges across pre-tokens, so ids of pre-tokens are
    remembered and strung together. Texts with added tokens or unusual characters, and
    all texts if the tokenizer is of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = json.loads(self.tokenizer.to_str())
        pre, model = kind["pre_tokenizer"] or {}, kind["model"]
        self.divides = (
            kind["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and model["type"] == "BPE"
            and not model.get("dropout")
        )
        marks = [t["content"] for t in kind["added_tokens"]]
        self.marked = re.compile("|".join(map(re.escape, marks))).search if marks else None
        self.known = Pieces(self.tokenizer)
        if self.divides:
            own = b"".join(map(self.known.__getitem__, _split(_TRIAL)))
            self.divides = own == self._whole(_TRIAL)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.older = {}
            self.known = Pieces(self.tokenizer, self.known)
        return [self._one(text) for text in texts]

    def _one(self, text):
        if not self.divides or _UNSURE(text) or (self.marked and self.marked(text)):
            return self._whole(text)
        return b"".join(map(self.known.__getitem__, _split(text)))

    def _whole(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, limit: int, first: int):
        self.size, self.limit, self.number = size, limit, first
        self.windows: list[tuple[int, list]] = []  # (room, pieces), unordered
        self.done: list[tuple[int, list]] = []  # (sequence, pieces), emitted

    def emit(self, pieces):
        self.done.append((self.number, pieces))
        self.number += 1

    def add(self, doc_id, start, ids, doc_tokens):
        size = self.size
        while len(ids) >= 4 * size:
            self.emit([(doc_id, start, ids[: 4 * size], doc_tokens)])
            start, ids = start + size, ids[4 * size :]
        while ids:
            need = len(ids) // 4
            best = min(
                (i for i, w in enumerate(self.windows) if w[0] >= need),
                key=lambda i: self.windows[i][0],
                default=None,
            )
            if best is None and len(self.windows) < self.limit:
                self.windows.append((size, []))
                best = len(self.windows) - 1
            if best is None:
                best = min(range(len(self.windows)), key=lambda i: self.windows[i][0])
            room, pieces = self.windows[best]
            pieces.append((doc_id, start, ids[: 4 * room], doc_tokens))
            start, ids = start + room, ids[4 * room :]
            if need >= room:
                self.emit(pieces)
                self.windows[best] = self.windows[-1]
                self.windows.pop()
            else:
                self.windows[best] = (room - need, pieces)

    def string_together(self):
        """Close all windows: full ones, then one for each power of two in the rest."""
        waiting = [p for _, pieces in sorted(self.windows, key=lambda w: w[0]) for p in pieces]
        self.windows = []
        left = sum(len(p[2]) // 4 for p in waiting)
        waiting.reverse()
        while left:
            room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc_id, start, ids, doc_tokens = waiting.pop()
                taken = min(room, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * taken], doc_tokens))
                if 4 * taken < len(ids):
                    waiting.append((doc_id, start + taken, ids[4 * taken :], doc_tokens))
                room -= taken
            self.emit(pieces)


_ROWS = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
        ("task", pa.int64()),
        ("waits", pa.bool_()),
    ]
)
_TYPES = (
    "sequence_id long, offset long, doc_id long, start long, length long, doc_tokens long, "
    "ids binary"
)


def _rows(windows, task, waits):
    """Batches of rows of (sequence, pieces)."""
    columns: list = [[] for _ in _ROWS]
    held = 0

    def batch():
        made = [pa.array(c, f.type) for c, f in zip(columns, _ROWS)]
        for column in columns:
            column.clear()
        return pa.record_batch(made, schema=_ROWS)

    for sequence, pieces in windows:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            row = (sequence, offset, doc_id, start, n, doc_tokens, ids, task, waits)
            for column, value in zip(columns, row):
                column.append(value)
            offset += n
        held += offset
        if held >= ID_BLOCK:
            yield batch()
            held = 0
    if columns[0]:
        yield batch()


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 2048,
    windows: int = 32,
    end_id: int | None = 1,
) -> DataFrame:
    """The pieces of all documents in sequences of at most ``size`` tokens: (sequence_id,
    offset, doc_id, start, length, doc_tokens, ids).

    ``start`` is the piece's place in its document, ``offset`` that in its sequence,
    ``ids`` has little-endian unsigned 32-bit numbers. A document's ids are followed by
    ``end_id``, if there is one, and doc_tokens counts it. Special tokens are not added;
    their strings in a text are taken as the tokenizer takes them by default. ``size``
    is a power of two. A sequence is full or has a power of two of tokens.

    A null text counts as empty: ``end_id`` alone, or no row without one. Repeated rows,
    also with one doc_id or none, are packed each for itself. An empty table gives no
    rows. Only doc_id and text are read.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size has to be a power of two")
    spark = docs.sparkSession
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def read(batches):
        task = TaskContext.get().partitionId()
        packer, coder = Packer(size, windows, task << 32), encoder(tokenizer_path)
        held = 0
        for batch in batches:
            for doc_ids, texts in _blocks(batch):
                for doc_id, ids in zip(doc_ids, coder.encode(texts)):
                    ids += end
                    held += len(ids)
                    packer.add(doc_id, 0, ids, len(ids) // 4)
                    if held > ID_BLOCK:
                        yield from _rows(packer.done, task, False)
                        packer.done, held = [], 0
        yield from _rows(packer.done, task, False)
        yield from _rows(((i, pieces) for i, (_, pieces) in enumerate(packer.windows)), task, True)

    path = scratch_path(spark, "packed")
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(read, f"{_TYPES}, task long, waits boolean")
        .write.partitionBy("waits")
        .parquet(path)
    )
    stored = spark.read.schema(f"{_TYPES}, task long, waits boolean").parquet(path)

    def merge(table):
        rows = sorted(
            zip(*(table.column(n).to_pylist() for n in ("length", "task", "sequence_id", "offset", "doc_id", "start", "ids", "doc_tokens"))),
            key=lambda r: (-r[0], *r[1:4]),
        )
        group = rows[0][1] // MERGED_TASKS
        packer = Packer(size, windows, MERGED + (group << 32))
        for _, _, _, _, doc_id, start, ids, doc_tokens in rows:
            packer.add(doc_id, start, ids, doc_tokens)
        packer.string_together()
        made = pa.Table.from_batches(_rows(packer.done, 0, False), _ROWS)
        return made.select([f.name for f in _ROWS][:7])

    waiting = stored.filter("waits").withColumn("_group", F.expr(f"task div {MERGED_TASKS}"))
    merged = waiting.drop("waits").groupBy("_group").applyInArrow(merge, _TYPES)
    return stored.filter("not waits").drop("task", "waits").unionByName(merged)


def _blocks(batch):
    """(doc_ids, texts) of bounded size, of one text at least."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        value = text.as_py() or ""
        if texts and held + len(value) > TEXT_BLOCK:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(doc_id)
        texts.append(value)
        held += len(value)
    if texts:
        yield ids, texts
