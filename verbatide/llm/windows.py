"""Windows of a fixed length that documents share: naming, grouping and sampling.

Strings are named by 64-bit polynomial fingerprints, from which the name of any
substring follows by two prefix sums. Each window is represented by the smallest name
of the shorter grams within it. Consecutive windows with one representative form a run,
so a document of n symbols has about 2n / (window - gram + 2) runs; equal windows have
equal representatives, wherever they stand. Nothing is sampled away: every window
belongs to exactly one run.
"""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fingerprints: an odd base with its inverse, and the mixer's factors.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

PIECE = 1 << 18
LONG_WORD = 256
# Bytes of texts that are worked on at once.
TEXTS = 1 << 20
_powers: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        row = np.full(max(n, PIECE + 4096), base, np.uint64)
        row[0] = 1
        held = _powers[base] = np.multiply.accumulate(row)
    return held[:n]


class Names:
    """Names of the substrings of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _power(_BASE, n), out=self.sums[1:])
        self.back = _power(_INVERSE, n + 1)

    def at(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n, size, least = len(x) - width + 1, 1, x
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[width - size : width - size + n])


def runs(symbols: np.ndarray, starts: np.ndarray, window: int, gram: int):
    """(representative, name, document, first, last) of the runs in documents that
    follow each other in ``symbols``; document i has starts[i]:starts[i + 1].

    ``name`` is that of the symbols first .. last + window; first and last count from
    the document's start. Long inputs go piece by piece; a run that spans two pieces
    becomes two.
    """
    found = []
    for at in range(0, max(0, len(symbols) - window + 1), PIECE):
        part = symbols[at : at + PIECE + window - 1]
        names = Names(part)
        least = sliding_least(names.grams(gram), window - gram + 1)
        place = np.arange(at, at + len(least))
        owner = np.searchsorted(starts, place, side="right") - 1
        whole = place + window <= starts[owner + 1]
        if not whole.any():
            continue
        edge = np.ones(len(least), bool)
        edge[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        # Only whole windows count; they come first in each document's part.
        edge[1:] |= whole[1:] & ~whole[:-1]
        first = np.flatnonzero(edge & whole)
        stop = np.flatnonzero(whole & np.append(edge[1:] | ~whole[1:], True))
        document = owner[first]
        name = names.at(first, stop + window)
        origin = starts[document] - at
        found.append((least[first], name, document, first - origin, stop - origin))
    if not found:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def seen_before(keys: list, document: np.ndarray) -> np.ndarray:
    """Whether a row's keys also occur with a smaller document among these rows."""
    order = np.lexsort((document, *keys))
    fresh = np.ones(len(order), bool)
    for key in keys:
        k = key[order]
        fresh[1:] &= k[1:] == k[:-1]
    fresh = ~fresh
    if len(fresh):
        fresh[0] = True
    first = document[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    seen = np.zeros(len(order), bool)
    seen[order] = document[order] > first
    return seen


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes one after another, and where each starts. Nulls are empty."""
    if pa.types.is_binary(column.type):
        column = column.fill_null(b"").cast(pa.large_binary())
    else:
        column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts_of(batch: pa.RecordBatch, column: str = "text", most: int = TEXTS):
    """The rows of a batch, in slices: as many as have texts of ``most`` bytes, and one
    at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < batch.num_rows:
        before = ends[at] - sizes[at]
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _word_names(padded: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: its length, then eight bytes after another, are mixed in.

    Mixing is not linear: polynomials modulo 2 ** 64 give one name to some pairs of long
    words. ``padded`` has eight bytes more. Words over LONG_WORD bytes have their XXH3.
    """
    size = ends - begins
    names = mix(size.astype(np.uint64) * np.uint64(_BASE))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        names[i] = xxhash.xxh3_64_intdigest(padded[begins[i] : ends[i]].tobytes())
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    live = np.flatnonzero(size <= LONG_WORD)
    done = 0
    while len(live):
        block = np.ascontiguousarray(eights[begins[live] + done]).view("<u8").ravel()
        rest = size[live] - done
        short = rest < 8
        block[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        names[live] = mix(names[live] ^ block)
        done += 8
        live = live[rest > 8]
    return names


def words_of(data: np.ndarray, starts: np.ndarray, inner: np.ndarray | None = None):
    """(symbols, each text's first word, first bytes, last bytes + 1) of all words.

    Words are what ASCII white space divides, or runs of the bytes in ``inner``, a
    table of 256 booleans. They end with their text. A symbol is a hash of the word.
    """
    solid = (data != 32) & ((data < 9) | (data > 13)) if inner is None else inner[data]
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    begins = np.flatnonzero(solid & (~before | border[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | border[1:])) + 1
    symbols = np.empty(len(begins), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for at in range(0, len(begins), PIECE):
        some = slice(at, at + PIECE)
        symbols[some] = _word_names(padded, begins[some], ends[some])
    return symbols, np.searchsorted(begins, starts), begins, ends


def texts_by_id(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) of the rows that take part, and ids whose rows differ in text.

    Rows without doc_id take no part. Of rows that share a doc_id but not the text,
    those with the text that comes first by hash do; the second result has these ids
    with that hash, or is None, as is usual.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("doc_id").isNotNull()
    )
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    torn = (
        rows.groupBy("doc_id")
        .agg(F.min(hashed).alias("chosen"), F.max(hashed).alias("other"))
        .filter(F.col("chosen") < F.col("other"))
        .select("doc_id", "chosen")
    )
    if torn.isEmpty():
        return rows, None
    chosen = rows.withColumn("hashed", hashed).join(torn, "doc_id", "left")
    chosen = chosen.filter(F.col("chosen").isNull() | (F.col("chosen") == F.col("hashed")))
    return chosen.select("doc_id", "text"), torn


def with_ranges(
    docs: DataFrame, torn: DataFrame | None, ranges: DataFrame, columns=("doc_id", "text")
) -> DataFrame:
    """Every row of ``docs``, of which ``columns``, with ``ranges``: the (lo, hi) of its
    doc_id, or null."""
    listed = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    rows = docs.select(*columns).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = rows.join(listed, "doc_id", "left")
    if torn is not None:
        hashed = F.xxhash64(F.coalesce("text", F.lit("")))
        joined = joined.join(torn, "doc_id", "left").withColumn(
            "ranges", F.when(F.col("chosen").isNull() | (F.col("chosen") == hashed), F.col("ranges"))
        )
    return joined.select(*columns, "ranges")


def range_arrays(column: pa.Array):
    """For each row (lo, hi) as arrays, or None where there are none."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten()
    lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
    end = np.cumsum(sizes)
    for size, stop in zip(sizes, end):
        yield (lo[stop - size : stop], hi[stop - size : stop]) if size else None


def covered(n: int, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """Which of n places lie in a window that starts in one of the ranges lo .. hi."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, lo, 1)
    np.add.at(change, hi + window, -1)
    return np.cumsum(change[:-1]) > 0


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of phases whose results are written: it does
    so once the driver's garbage collectors, Python's and then Java's in several rounds,
    have found their plans unused."""
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
