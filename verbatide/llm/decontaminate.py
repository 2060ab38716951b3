"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become word sequences (lower case, punctuation dropped).
Every match of ``least`` words or more consists of shared seeds, grams of that length.
While documents are read, a Bloom filter of the benchmark's seeds, of fixed size
whatever the benchmark's, leaves only stretches made of possible seeds. Their seeds are
joined to the benchmark's, which gives the (document, item) pairs to tile.

A pair is tiled by running Karp-Rabin: fingerprints of all unmarked grams of a length
are compared, matches are extended and marked, longest first, without overlap, and the
length is lowered until it is ``least``. A document is contaminated by an item if its
tiles cover a given share of the item, in whatever order they stand.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.windows import Names, parts_of, words_of
from verbatide.storage import cut_lineage

BLOOM_BITS = 1 << 26
_HASHES = 3

# Word bytes: ASCII letters, digits and underscore, and all of longer characters.
_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), 95, *range(97, 123), *range(128, 256)]] = True
# Signs among longer characters: Latin-1 signs, general and CJK punctuation.
_MARKS = re.compile("[\x80-\xbf\xd7\xf7\u2000-\u206f\u3000-\u303f]")


def token_symbols(column: pa.Array):
    """(symbols of all texts one after another, where each text starts)."""
    texts = []
    for value in column:
        text = (value.as_py() or "").lower()
        if not text.isascii():
            text = _MARKS.sub(" ", text)
        texts.append(text.encode())
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    data = np.frombuffer(b"".join(texts), np.uint8)
    symbols, at, _, _ = words_of(data, starts, _INNER)
    return symbols, at


def token_parts(batch: pa.RecordBatch, column: str = "text"):
    """(rows, symbols, where each text starts) of a batch, part by part: the symbols of
    a text take many times its bytes, so that no whole batch's are held at once."""
    for part in parts_of(batch, column):
        yield part, *token_symbols(part.column(column))


def _probes(seeds: np.ndarray):
    for k in range(_HASHES):
        yield (seeds >> np.uint64(20 * k)) % np.uint64(BLOOM_BITS)


def bloom_of(seeds) -> np.ndarray:
    bits = np.zeros(BLOOM_BITS, bool)
    for part in seeds:
        for probe in _probes(part):
            bits[probe.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def in_bloom(bloom: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    found = np.ones(len(seeds), bool)
    for probe in _probes(seeds):
        probe = probe.astype(np.int64)
        found &= (bloom[probe >> 3] >> (probe & 7).astype(np.uint8)) & 1 == 1
    return found


def _matches(doc: Names, item: Names, free_doc, free_item, size):
    """Places (in the document, in the item) of equal, wholly unmarked grams."""
    own, other = _free_grams(free_doc, size), _free_grams(free_item, size)
    table: dict = {}
    for place, name in zip(other.tolist(), item.at(other, other + size).tolist()):
        table.setdefault(name, []).append(place)
    for place, name in zip(own.tolist(), doc.at(own, own + size).tolist()):
        for start in table.get(name, ()):
            yield place, start


def _free_grams(free, size):
    if len(free) < size:
        return np.zeros(0, np.int64)
    marked = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(marked[size:] == marked[:-size])


def tile(stretches: list, item: np.ndarray, least: int) -> int:
    """How many of the item's words greedy tiles cover.

    Of equally long matches the one that comes first in the document, then in the item,
    is marked first.
    """
    # Stretches are apart: nothing may match across their borders.
    doc = np.concatenate([np.append(s, np.uint64(0)) for s in stretches])
    free_doc = doc != 0
    free_item = np.ones(len(item), bool)
    names_doc, names_item = Names(doc), Names(item)
    size = max(least, len(item) // 2)
    covered = 0
    while True:
        found, longest = {}, 0
        for i, j in _matches(names_doc, names_item, free_doc, free_item, size):
            # Only the start of a maximal match counts.
            if i and j and free_doc[i - 1] and free_item[j - 1] and doc[i - 1] == item[j - 1]:
                continue
            n = size
            while (
                i + n < len(doc)
                and j + n < len(item)
                and free_doc[i + n]
                and free_item[j + n]
                and doc[i + n] == item[j + n]
            ):
                n += 1
            found[i, j] = n
            longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        left = False
        for (i, j), n in sorted(found.items(), key=lambda m: (-m[1], m[0])):
            if free_doc[i : i + n].all() and free_item[j : j + n].all():
                free_doc[i : i + n] = free_item[j : j + n] = False
                covered += n
            else:
                left = True
        if left:
            # What was cut off by a longer tile may still hold a match of this length.
            continue
        if size == least:
            return covered
        size = max(least, size // 2)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5
) -> DataFrame:
    """(doc_id, item_id, item_words, tiled_words, coverage) of contaminated documents.

    One row for each document and each item of which tiles of ``least`` words or more
    cover the share ``coverage`` or more. Texts that are null or have fewer words than
    ``least`` match nothing, nor do rows without doc_id or item_id. Of rows that repeat
    a doc_id and item_id with other texts, the best covered pair counts. Empty tables
    give no rows.
    """

    def seeds(batches):
        for part, symbols, at in chain.from_iterable(map(token_parts, batches)):
            for i in range(part.num_rows):
                own = symbols[at[i] : at[i + 1]]
                names = Names(own).grams(least) if len(own) >= least else own[:0]
                yield pa.record_batch(
                    [
                        part.column(0)[i : i + 1],
                        _lists([own], pa.int64()),
                        _lists([np.unique(names)], pa.int64()),
                    ],
                    names=["item_id", "words", "seeds"],
                )

    items = cut_lineage(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .filter("item_id is not null")
        .mapInArrow(seeds, "item_id long, words array<long>, seeds array<long>")
        .filter(F.size("seeds") > 0)
    )
    spark = docs.sparkSession
    blooms = items.select("seeds").mapInArrow(_bloom_rows, "bloom binary").toLocalIterator()
    bloom = np.zeros(BLOOM_BITS // 8, np.uint8)
    for row in blooms:
        bloom |= np.frombuffer(row["bloom"], np.uint8)
    shared = spark.sparkContext.broadcast(bloom)

    def stretches(batches):
        bits = shared.value
        for part, symbols, at in chain.from_iterable(map(token_parts, batches)):
            ids, rows = part.column(0), ([], [], [])
            for i in range(part.num_rows):
                own = symbols[at[i] : at[i + 1]]
                if len(own) < least:
                    continue
                names = Names(own).grams(least)
                hit = in_bloom(bits, names)
                if not hit.any():
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                rows[0].append(i)
                rows[1].append(np.unique(names[hit]))
                parts = [own[a : b + least - 1] for a, b in edge.reshape(-1, 2)]
                rows[2].append(np.concatenate([np.append(p, np.uint64(0)) for p in parts]))
            yield pa.record_batch(
                [
                    ids.take(pa.array(rows[0], pa.int64())),
                    _lists(rows[1], pa.int64()),
                    _lists(rows[2], pa.int64()),
                ],
                names=["doc_id", "seeds", "stretches"],
            )

    found = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .filter("doc_id is not null")
        .mapInArrow(stretches, "doc_id long, seeds array<long>, stretches array<long>")
        .withColumn("place", F.monotonically_increasing_id())
    )
    wanted = items.select("item_id", F.explode("seeds").alias("seed"))
    pairs = (
        found.select("place", F.explode("seeds").alias("seed"))
        .join(wanted, "seed")
        .select("place", "item_id")
        .distinct()
    )

    def tiled(batches):
        for batch in batches:
            words = batch.column("words")
            covered = [
                tile(_split(s.values.to_numpy().view(np.uint64)), w.values.to_numpy().view(np.uint64), least)
                for s, w in zip(batch.column("stretches"), words)
            ]
            total = words.value_lengths().cast(pa.int64())
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("item_id"), total, pa.array(covered, pa.int64())],
                names=["doc_id", "item_id", "item_words", "tiled_words"],
            )

    share = F.col("tiled_words") / F.col("item_words")
    return (
        pairs.join(found.select("place", "doc_id", "stretches"), "place")
        .join(items.select("item_id", "words"), "item_id")
        .select("doc_id", "item_id", "stretches", "words")
        .mapInArrow(tiled, "doc_id long, item_id long, item_words long, tiled_words long")
        .withColumn("coverage", share)
        .filter(F.col("coverage") >= coverage)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("coverage", "tiled_words", "item_words")).alias("best"))
        .select("doc_id", "item_id", "best.item_words", "best.tiled_words", "best.coverage")
    )


def _bloom_rows(batches):
    seeds = (b.column(0).flatten().to_numpy().view(np.uint64) for b in batches)
    yield pa.record_batch([pa.array([bloom_of(seeds).tobytes()], pa.binary())], names=["bloom"])


def _lists(rows, kind):
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.concatenate([np.zeros(0, np.uint64), *rows]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _split(flat: np.ndarray) -> list:
    ends = np.flatnonzero(flat == 0)
    return [flat[a:b] for a, b in zip(np.append(0, ends[:-1] + 1), ends)]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with their columns."""
    leaks = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(leaks, docs["doc_id"].cast("long") == leaks["doc_id"], "left_anti")
