"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a maximal stretch of words with a smallest period that fits into it twice. For
each period q, words at the points of a grid are compared with those q further on: a
run's stretch of equal pairs is at least as long as the grid's step, so it holds a grid
point, and the common extensions from there, forwards and backwards, give its ends.
Steps grow with q, so n words have n log n grid points, in blocks of bounded size.

Common extensions take constant time. Of every 13 places 4 belong to a difference cover:
only suffixes that start there are sorted. For any two places there is a shift below 13
that takes both into the cover, so the few words before are compared and the rest is a
range minimum, from a sparse table, over the common prefixes of neighbouring suffixes.

Documents are read where they lie, without a shuffle; several short ones share their
arrays, and never a match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A perfect difference cover, every residue is a difference of two of them.
CYCLE, COVER = 13, (0, 1, 3, 9)
# Words whose arrays are built together, if documents are short, and grid points at once.
WORD_BLOCK, GRID_BLOCK = 1 << 18, 1 << 20

_IN_COVER = np.zeros(CYCLE, bool)
_IN_COVER[list(COVER)] = True
# The shift that takes places of residues a and b into the cover.
_SHIFT = np.array(
    [
        [next(s for s in range(CYCLE) if _IN_COVER[(a + s) % CYCLE] and _IN_COVER[(b + s) % CYCLE]) for b in range(CYCLE)]
        for a in range(CYCLE)
    ]
)


def _ranked(*keys: np.ndarray):
    """(rank of each row of keys, number of ranks); the last key counts most."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for key in keys:
        held = key[order]
        new[1:] |= held[1:] != held[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank, int(new.sum()) + 1


class Extensions:
    """Common extensions of places of a sequence whose documents end with symbols that
    occur once, so that no match passes a document's end."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        # Words beyond the end, where nothing has to match.
        self.symbols = np.concatenate([symbols, np.arange(-1, -CYCLE - 1, -1)])
        place = np.arange(n)
        sampled = place[_IN_COVER[place % CYCLE]]
        self.index = np.full(n + CYCLE + 1, -1, np.int64)
        self.index[sampled] = np.arange(len(sampled))
        # Ranks of the first 13 words, three of them in one key.
        least = self.symbols.min()
        packed = self.symbols - least
        base = int(packed.max()) + 1
        fold = 3 if base < 1 << 20 else 1
        keys = []
        for at in range(0, CYCLE, fold):
            key = np.zeros(len(sampled), np.int64)
            for step in range(at, min(at + fold, CYCLE)):
                key = key * base + packed[sampled + step]
            keys.append(key)
        rank, number = _ranked(*reversed(keys))
        levels, length = [rank], CYCLE
        # The sampled suffix 13, 26, ... words further on is sampled too.
        while number < len(sampled):
            follow = np.minimum(sampled + length, n)
            after = self.index[follow]
            after = np.where(after >= 0, rank[after] + 1, 0)
            rank, number = _ranked(after, rank)
            levels.append(rank)
            length *= 2
        self.rank = rank
        suffix = np.empty(len(rank), np.int64)
        suffix[rank] = sampled
        self.table = [self._neighbours(suffix, levels, n)]
        while 2 << (len(self.table) - 1) <= len(suffix):
            half, row = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(row[:-half], row[half:]))

    def _neighbours(self, suffix, levels, n):
        """Words that each suffix in order has in common with the one before."""
        a, b = suffix[:-1].copy(), suffix[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            i, j = self.index[np.minimum(a, n)], self.index[np.minimum(b, n)]
            equal = (i >= 0) & (j >= 0) & (levels[level][i] == levels[level][j])
            step = np.where(equal, CYCLE << level, 0)
            a, b, common = a + step, b + step, common + step
        alive = np.ones(len(a), bool)
        for _ in range(CYCLE - 1):
            alive &= self.symbols[np.minimum(a, n)] == self.symbols[np.minimum(b, n + 1)]
            alive &= (a < n) & (b < n)
            if not alive.any():
                break
            common += alive
            a, b = a + alive, b + alive
        return common

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b > a on are equal."""
        shift = _SHIFT[a % CYCLE, b % CYCLE]
        common = np.zeros(len(a), np.int64)
        alive = np.ones(len(a), bool)
        for step in range(CYCLE - 1):
            open_ = np.flatnonzero(alive & (step < shift))
            if not len(open_):
                break
            same = self.symbols[a[open_] + step] == self.symbols[b[open_] + step]
            common[open_] += same
            alive[open_[~same]] = False
        rest = np.flatnonzero(alive)
        # A place beyond the end has no suffix, and nothing in common.
        i, j = self.index[a[rest] + shift[rest]], self.index[b[rest] + shift[rest]]
        held = (i >= 0) & (j >= 0)
        rest, i, j = rest[held], self.rank[i[held]], self.rank[j[held]]
        low, high = np.minimum(i, j), np.maximum(i, j)
        size = np.frexp(high - low)[1] - 1
        for level in np.unique(size):
            own = size == level
            row = self.table[level]
            common[rest[own]] += np.minimum(row[low[own]], row[high[own] - (1 << level)])
        return common


def find_runs(symbols: np.ndarray, ends: np.ndarray, least: int):
    """(document, start, length, period) of all runs, by document, start, then period.

    ``symbols`` are the documents' words, each document followed by a symbol that occurs
    nowhere else; document i ends, with it, at ends[i]. Documents come longest first.
    """
    n = len(symbols)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts - 1
    ahead = behind = None
    found: list = []

    def extend(grid, period):
        nonlocal ahead, behind
        if ahead is None:
            ahead, behind = Extensions(symbols), Extensions(symbols[::-1].copy())
        step = np.maximum(period, least - period)
        forth = ahead.forward(grid, grid + period)
        # The places before, as they are counted from the other end.
        inner = np.flatnonzero(grid > 0)
        back = np.zeros(len(grid), np.int64)
        back[inner] = behind.forward(n - (grid + period)[inner], n - grid[inner])
        long = forth + back >= step
        start, end = (grid - back)[long], (grid + forth + period)[long]
        if len(start):
            period = period[long]
            order = np.lexsort((period, end, start))
            start, end, period = start[order], end[order], period[order]
            new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
            found.append((start[new], end[new], period[new]))

    waiting: list = []
    held = 0
    longest = int(sizes.max(initial=0))
    for q in range(1, longest // 2 + 1):
        step = max(q, least - q)
        # Documents that hold a run of this period at all.
        live = int(np.searchsorted(-sizes, -max(least, 2 * q), side="right"))
        if not live:
            break
        upto = int(ends[live - 1])
        grid = np.arange(0, upto - q, step)
        # A stretch of equal pairs has one at the point and, if of two or more, one beside it.
        grid = grid[symbols[grid] == symbols[grid + q]]
        if len(grid) and step > 1:
            beside = symbols[grid + 1] == symbols[np.minimum(grid + 1 + q, n - 1)]
            before = (grid > 0) & (symbols[grid - 1] == symbols[grid - 1 + q])
            grid = grid[beside | before]
        if len(grid):
            waiting.append((grid, np.full(len(grid), q)))
            held += len(grid)
        if held > GRID_BLOCK:
            extend(*(np.concatenate(c) for c in zip(*waiting)))
            waiting, held = [], 0
    if waiting:
        extend(*(np.concatenate(c) for c in zip(*waiting)))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, end, period = (np.concatenate(c) for c in zip(*found))
    # A stretch found for several periods counts for the smallest.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    document = np.searchsorted(ends, start, side="right")
    return document, start - starts[document], end - start, period


def _texts_runs(texts: list[bytes], least: int):
    """For each text its words, and arrays start, length, period of its runs."""
    words = [text.split() for text in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(words[i]))
    code: dict = {}
    sizes = np.array([len(words[i]) + 1 for i in order])
    ends = np.cumsum(sizes)
    symbols = np.empty(int(ends[-1]), np.int64)
    for i, end, size in zip(order, ends.tolist(), sizes.tolist()):
        symbols[end - size : end - 1] = [code.setdefault(w, len(code)) for w in words[i]]
    symbols[ends - 1] = len(code) + np.arange(len(ends))
    document, start, length, period = find_runs(symbols, ends, least)
    first = np.searchsorted(document, np.arange(len(order) + 1))
    runs: list = [None] * len(order)
    for at, i in enumerate(order):
        own = slice(first[at], first[at + 1])
        runs[i] = (start[own], length[own], period[own])
    return words, runs


def _collapsed(words, runs) -> bytes:
    start, length, period = runs
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join(w for w, k in zip(words, kept.tolist()) if k)


def collapse_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of ``docs``.

    Words are what ASCII white space divides, compared byte for byte. ``runs`` lists
    (start, length, period) of every stretch of words with smallest period q and a
    length of at least ``least`` and 2q that no neighbouring word extends, by start,
    then period; starts count words from 0. ``collapsed`` is the text, joined by single
    spaces, less every word that some run holds after its first q words.

    Null and blank texts have no runs and an empty result. Repeated rows, also with one
    doc_id or none, are judged each for itself. An empty table gives no rows. Only
    doc_id and text are read.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def read(batches):
        for batch in batches:
            for ids, texts in _blocks(batch):
                words, runs = _texts_runs(texts, least)
                listed = [np.concatenate([r[k] for r in runs]) for k in range(3)]
                offsets = np.cumsum([0, *(len(r[0]) for r in runs)]).astype(np.int32)
                structs = pa.StructArray.from_arrays(list(map(pa.array, listed)), fields=list(item))
                collapsed = [_collapsed(w, r).decode() for w, r in zip(words, runs)]
                yield pa.record_batch(
                    [ids, pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(collapsed, pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        read,
        "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def _blocks(batch):
    """(ids, texts) of bounded size, of one text at least."""
    at, held, texts = 0, 0, []
    for i, text in enumerate(batch.column(1)):
        value = (text.as_py() or "").encode()
        # A word takes two bytes at least.
        if texts and held + len(value) // 2 > WORD_BLOCK:
            yield batch.column(0).slice(at, len(texts)), texts
            at, held, texts = i, 0, []
        texts.append(value)
        held += len(value) // 2 + 1
    if texts:
        yield batch.column(0).slice(at, len(texts)), texts
