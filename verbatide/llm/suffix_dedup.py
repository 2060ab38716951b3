"""Removal of byte strings that earlier documents hold, by distributed prefix doubling.

Positions are ranked by prefixes of growing length; Spark sorts the ranks, a position
whose rank no other document has is unique and leaves, the others are ranked anew by a
pair of ranks at a larger offset, until the prefix is as long as the threshold.

A rank is a fingerprint, so equal prefixes have equal ranks without a join back to all
positions. Neighbouring positions are ranked together as long as one gram stands for
them (see windows.py):

1. 20 bytes: the gram that stands for a run of positions. Most are unique.
2. The pair (gram, whole run): where it repeats, all positions of the run are past the
   threshold at once. Where only the gram repeats, the run goes on to round 3.
3. 43 bytes: the core that up to eight neighbouring positions share, at a distance from
   the gram that is a multiple of eight. Most lines shorter than the threshold end here.
4. Single positions of what is left: pairs (25 bytes, the 25 bytes at offset 25).

A task first drops what it sees repeated itself, so that the rows of a rank are bounded
by the tasks, whatever share of the documents holds it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbatide.llm.windows import (
    BYTE_SYMBOLS,
    PIECE,
    Names,
    covered,
    mix,
    range_arrays,
    release,
    runs,
    seen_before,
    text_bytes,
    texts_by_id,
    with_ranges,
)
from verbatide.storage import scratch_path

GRAM = 20
# Neighbouring positions with one core; bits of a run's length in a packed place.
_STEP, _PLACE = 8, 20


def _batch(**columns):
    return pa.record_batch([pa.array(c) for c in columns.values()], names=list(columns))


def _spread(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Names that only spread rows evenly."""
    return mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))


def _ranked_runs(window: int, gram: int):
    def rank(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for data, starts, ids in _parts(data, starts, ids):
                least, name, owner, lo, hi = runs(BYTE_SYMBOLS[data], starts, window, gram)
                doc = ids[owner]
                again = seen_before([least, name], doc)
                # Decided rows need no partner: their ranks only spread them evenly.
                least[again] = _spread(doc, lo)[again]
                yield _batch(
                    rank=least.view(np.int64),
                    run=name.view(np.int64),
                    doc_id=doc,
                    place=(lo << _PLACE) | ((hi - lo) << 1) | again,
                )

    return rank


def _parts(data, starts, ids, most=16 * PIECE):
    """The documents of a batch in parts of bounded size (a longer one for itself)."""
    at = 0
    while at < len(ids):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1)
        yield data[starts[at] : starts[end]], starts[at : end + 1] - starts[at], ids[at:end]
        at = end


def _cores(window: int, gram: int):
    """Rows of up to _STEP neighbouring positions: their core, and their bytes."""

    def cut(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            out, held = _no_rows(), 0
            for i, found in enumerate(range_arrays(batch.column("ranges"))):
                if found is None:
                    continue
                own = data[starts[i] : starts[i + 1]]
                for at in range(0, len(own), PIECE):
                    lo, hi = np.maximum(found[0], at), np.minimum(found[1], at + PIECE - 1)
                    lo, hi = lo[lo <= hi] - at, hi[lo <= hi] - at
                    if not len(lo):
                        continue
                    part = own[at : at + PIECE + window - 1]
                    names = Names(BYTE_SYMBOLS[part])
                    first, last, core = _segments(names, lo, hi, window, gram)
                    text = part.tobytes()
                    pieces = [text[a : b + window] for a, b in zip(first.tolist(), last.tolist())]
                    rows = core, names.at(first, last + window), np.full(len(first), ids[i]), first + at
                    for column, values in zip(out, (*rows, pieces)):
                        column.append(values)
                    held += len(first)
                if held > PIECE // 4:
                    yield _core_batch(out)
                    out, held = _no_rows(), 0
            if held:
                yield _core_batch(out)

    return cut


def _no_rows():
    return [], [], [], [], []


def _core_batch(out):
    core, name, doc, lo = (np.concatenate(c) for c in out[:4])
    again = seen_before([core, name], doc)
    core[again] = _spread(doc, lo)[again]
    pieces = [p for part in out[4] for p in part]
    return _batch(core=core.view(np.int64), doc_id=doc, lo=lo, again=again, piece=pieces)


def _segments(names: Names, lo, hi, window: int, gram: int):
    """Positions lo .. hi, divided so that each part lies in one step of distances from
    the gram that stands for it: (first, last, name of the core) of each part."""
    width = window - gram + 1
    sizes = hi - lo + 1
    spread = lambda start, n: np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
    place = spread(lo, sizes)
    owner = np.repeat(np.arange(len(lo)), sizes)
    # The grams within a run's windows, and where the least of them stands.
    inside = spread(lo, sizes + width - 1)
    values = names.at(inside, inside + gram)
    least = np.minimum.reduceat(values, np.cumsum(sizes + width - 1) - sizes - width + 1)
    hit = values == np.repeat(least, sizes + width - 1)
    # Places with their run, so that the next one is looked up within the run.
    stride = len(names.sums) + window
    at = inside[hit] + stride * np.repeat(np.arange(len(lo)), sizes + width - 1)[hit]
    anchor = at[np.searchsorted(at, place + stride * owner)] - stride * owner
    bucket = (anchor - place) // _STEP
    edge = np.ones(len(place), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(place)) - 1
    core = anchor[begin] - bucket[begin] * _STEP
    return place[begin], place[end], names.at(core, core + window - _STEP + 1)


def _positions(window: int):
    """The positions of each piece, by the pair of names of their halves."""
    half = window // 2

    def rank(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("piece"))
            doc, lo = batch.column("doc_id").to_numpy(), batch.column("lo").to_numpy()
            for at in range(0, batch.num_rows, PIECE // 64):
                some = slice(at, at + PIECE // 64)
                own = starts[at : at + PIECE // 64 + 1]
                names = Names(BYTE_SYMBOLS[data[own[0] : own[-1]]])
                sizes = np.diff(own) - window + 1
                turn = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                p = np.repeat(own[:-1] - own[0], sizes) + turn
                first, second = names.at(p, p + half), names.at(p + half, p + window)
                own_doc, place = np.repeat(doc[some], sizes), np.repeat(lo[some], sizes) + turn
                again = seen_before([first, second], own_doc)
                first[again] = _spread(own_doc, place)[again]
                yield _batch(
                    first=first.view(np.int64),
                    second=second.view(np.int64),
                    doc_id=own_doc,
                    lo=place,
                    again=again,
                )

    return rank


def repeated_ranges(texts: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """(doc_id, lo, hi): windows starting at lo .. hi that a smaller doc_id holds too.

    ``texts`` has (doc_id, text) with doc_ids that are not null and unique, or repeat
    with the same text.
    """
    spark = texts.sparkSession
    decided = scratch_path(spark, "repeated-runs")
    by_rank = Window.partitionBy("rank")
    (
        # Sorted once; both windows below keep to this order.
        texts.mapInArrow(_ranked_runs(window, gram), "rank long, run long, doc_id long, place long")
        .repartition("rank")
        .sortWithinPartitions("rank", "run")
        .withColumns(
            {
                "lowest": F.min("doc_id").over(by_rank),
                "highest": F.max("doc_id").over(by_rank),
                "one": F.min("run").over(by_rank),
                "last": F.max("run").over(by_rank),
                "again": F.col("place").bitwiseAND(1) == 1,
            }
        )
        .filter("again or lowest < highest")
        .withColumn("again", F.expr("again or doc_id > min(doc_id) over (partition by rank, run)"))
        .filter("again or one < last")
        .withColumn("lo", F.shiftright("place", _PLACE))
        .withColumn("hi", F.col("lo") + F.shiftright("place", 1).bitwiseAND((1 << _PLACE - 1) - 1))
        .select("doc_id", "lo", "hi", "again")
        .write.parquet(decided)
    )
    release(spark)
    rows = spark.read.schema("doc_id long, lo long, hi long, again boolean").parquet(decided)
    left = rows.filter("not again").groupBy("doc_id").agg(
        F.collect_list(F.struct("lo", "hi")).alias("ranges")
    )
    by_core, by_pair = Window.partitionBy("core"), Window.partitionBy("first", "second")
    columns = "core long, doc_id long, lo long, again boolean, piece binary"
    cores = (
        texts.join(left, "doc_id")
        .mapInArrow(_cores(window, gram), columns)
        .withColumns({"lowest": F.min("doc_id").over(by_core), "highest": F.max("doc_id").over(by_core)})
        .filter("again or lowest < highest")
        .select("doc_id", "lo", "again", "piece")
    )
    pieces = scratch_path(spark, "shared-cores")
    cores.write.parquet(pieces)
    release(spark)
    cores = spark.read.schema("doc_id long, lo long, again boolean, piece binary").parquet(pieces)
    last = F.col("lo") + F.length("piece") - window
    known = cores.filter("again").select("doc_id", "lo", last.alias("hi"))
    single = (
        cores.filter("not again")
        .select("doc_id", "lo", "piece")
        .mapInArrow(
            _positions(window), "first long, second long, doc_id long, lo long, again boolean"
        )
        .withColumn("lowest", F.min("doc_id").over(by_pair))
        .filter("again or doc_id > lowest")
        .select("doc_id", "lo", F.col("lo").alias("hi"))
    )
    whole = rows.filter("again").select("doc_id", "lo", "hi")
    return whole.unionByName(known).unionByName(single)


def _cut(own: np.ndarray, found, window: int):
    """(kept bytes, bytes removed, maximal runs removed) of a text with its ranges."""
    if found is None:
        return own, 0, 0
    gone = covered(len(own), *found, window)
    return own[~gone], int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    Each byte covered by a ``window``-byte string that also starts in a document with
    a smaller doc_id goes; overlaps count, and strings are judged on the input. A null
    text is empty. Rows without doc_id come back whole. Rows that repeat a doc_id are
    one document, as texts_by_id tells. An empty table gives no rows.
    """
    texts, torn = texts_by_id(docs)
    ranges = repeated_ranges(texts, window, gram)

    def cut(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            out: tuple = ([], [], [], [])
            for i, found in enumerate(range_arrays(batch.column("ranges"))):
                own = data[starts[i] : starts[i + 1]]
                kept, removed, spans = _cut(own, found, window)
                digest = hashlib.sha256(kept.tobytes()).hexdigest()
                for column, value in zip(out, (len(own), removed, spans, digest)):
                    column.append(value)
            yield _batch(
                doc_id=batch.column("doc_id"),
                n_bytes=pa.array(out[0], pa.int64()),
                n_removed=pa.array(out[1], pa.int64()),
                n_spans=pa.array(out[2], pa.int64()),
                kept_sha256=pa.array(out[3], pa.string()),
            )

    return with_ranges(docs, torn, ranges).mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def cut_repeats(docs: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs``, with their columns, less the repeated bytes of their texts.

    As remove_repeats. What is left of a character that was cut in two goes as well. A
    row whose text is cut to nothing goes; rows that had none stay, and so does null.
    """
    texts, torn = texts_by_id(docs)
    ranges = repeated_ranges(texts, window, gram)
    plain = [c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)]

    def cut(batches):
        for batch in batches:
            column = batch.column("text")
            data, starts = text_bytes(column)
            kept = []
            for i, found in enumerate(range_arrays(batch.column("ranges"))):
                if found is None:
                    kept.append(column[i].as_py())
                    continue
                own, _, _ = _cut(data[starts[i] : starts[i + 1]], found, window)
                kept.append(own.tobytes().decode("utf-8", "ignore"))
            emptied = [k == "" and starts[i] < starts[i + 1] for i, k in enumerate(kept)]
            columns = [
                pa.array(kept, pa.string()) if c == "text" else batch.column(c) for c in plain
            ]
            yield pa.record_batch([*columns, pa.array(emptied, pa.bool_())], names=[*plain, "emptied"])

    renamed = docs.toDF(*plain)
    types = dict(renamed.dtypes) | {"doc_id": "bigint"}
    schema = ", ".join(f"`{c}` {types[c]}" for c in plain) + ", emptied boolean"
    cut_rows = with_ranges(renamed, torn, ranges, plain).mapInArrow(cut, schema)
    return cut_rows.filter("not emptied").select(
        *[F.col(p).alias(c) for p, c in zip(plain, docs.columns)]
    )
