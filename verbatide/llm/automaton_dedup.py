"""Removal of word windows that earlier documents hold, by suffix automata.

Reference text is as large as the corpus, so it is neither broadcast nor streamed past
every document. It is cut into passages that could match at all: runs of windows with
one representative gram (see windows.py) that several documents have. Passages with
the same gram go to the same shard, where equal windows must therefore meet.

A shard enters its passages into one suffix automaton, by document id. Each state
knows the smallest document that holds its strings. The shard's passages are streamed
through the automaton for matching statistics: at each word, the longest suffix that a
smaller document holds. Where it reaches the threshold, the window goes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbatide.llm.suffix_dedup import _batch, _parts, _spread
from verbatide.llm.windows import (
    PIECE,
    covered,
    range_arrays,
    runs,
    seen_before,
    text_bytes,
    texts_by_id,
    with_ranges,
    words_of,
)
from verbatide.storage import scratch_path

GRAM = 8
# Passages of a shard on average, which bounds its automaton (about 70 words each).
SHARD_PASSAGES = 1024


class SuffixAutomaton:
    """Generalised suffix automaton over words; texts come in order of their document."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.document = [-1]

    def _state(self, length, link, following, document):
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.document.append(document)
        return len(self.next) - 1

    def _split(self, at, word, to):
        """The state of the shorter strings of ``to``, which end ``at`` and the word."""
        copy = self._state(
            self.length[at] + 1, self.link[to], dict(self.next[to]), self.document[to]
        )
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, words, document):
        following, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            to = following[last].get(word)
            if to is not None:
                last = to if length[to] == length[last] + 1 else self._split(last, word, to)
                continue
            state = self._state(length[last] + 1, 0, {}, document)
            at = last
            while at >= 0 and word not in following[at]:
                following[at][word] = state
                at = link[at]
            if at >= 0:
                to = following[at][word]
                link[state] = to if length[to] == length[at] + 1 else self._split(at, word, to)
            last = state

    def matches(self, words, document, least):
        """For each word, whether a string of ``least`` words that ends with it also
        ends in a smaller document."""
        following, link, length, owner = self.next, self.link, self.length, self.document
        at = size = 0
        for word in words:
            while at and word not in following[at]:
                at = link[at]
                size = length[at]
            to = following[at].get(word)
            if to is None:
                size = 0
            else:
                at, size = to, size + 1
            # Matching statistics: longer strings have fewer documents.
            state, have = at, size
            while have >= least and owner[state] >= document:
                state = link[state]
                have = length[state]
            yield have >= least


def _ranked_runs(window: int, gram: int):
    def rank(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for data, starts, ids in _parts(data, starts, ids):
                symbols, at, _, _ = words_of(data, starts)
                least, name, owner, lo, hi = runs(symbols, at, window, gram)
                doc = ids[owner]
                again = seen_before([least, name], doc)
                least[again] = _spread(doc, lo)[again]
                yield _batch(
                    rank=least.view(np.int64),
                    doc_id=doc,
                    lo=lo.astype(np.int32),
                    hi=hi.astype(np.int32),
                    again=again,
                )

    return rank


def _passages(window: int):
    """The words of each run, cut from its document; again as in the rounds above."""

    def cut(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            listed = batch.column("ranges")
            rank = listed.flatten().field("rank").to_numpy()
            out, held, done = _empty(), 0, 0
            for i, found in enumerate(range_arrays(listed)):
                if found is None:
                    continue
                own = data[starts[i] : starts[i + 1]]
                _, _, begins, ends = words_of(own, np.array([0, len(own)]))
                text = own.tobytes()
                for r, lo, hi in zip(rank[done : done + len(found[0])].tolist(), *map(np.ndarray.tolist, found)):
                    passage = b" ".join(text[begins[lo] : ends[hi + window - 1]].split())
                    held += len(passage)
                    for column, value in zip(out, (r, int(ids[i]), lo, hi, passage)):
                        column.append(value)
                done += len(found[0])
                if held > 16 * PIECE:
                    yield _cut_batch(out)
                    out, held = _empty(), 0
            yield _cut_batch(out)

    return cut


def _empty():
    return [], [], [], [], []


def _cut_batch(out):
    rank, doc, lo, hi, passage = out
    least: dict = {}
    for d, p in zip(doc, passage):
        least[p] = min(d, least.get(p, d))
    again = [d > least[p] for d, p in zip(doc, passage)]
    return pa.record_batch(
        [
            pa.array(rank, pa.int64()),
            pa.array(doc, pa.int64()),
            pa.array(lo, pa.int32()),
            pa.array(hi, pa.int32()),
            pa.array([None if a else p for a, p in zip(again, passage)], pa.binary()),
            pa.array(again, pa.bool_()),
        ],
        names=["rank", "doc_id", "lo", "hi", "passage", "again"],
    )


def _match_shard(window: int):
    def match(table):
        table = table.combine_chunks()
        doc, lo, hi = (table.column(c).to_pylist() for c in ("doc_id", "lo", "hi"))
        passages = table.column("passage").to_pylist()
        automaton = SuffixAutomaton()
        first: dict = {}
        order = sorted((i for i, p in enumerate(passages) if p is not None), key=doc.__getitem__)
        for i in order:
            if passages[i] not in first:
                first[passages[i]] = doc[i]
                automaton.add(passages[i].split(b" "), doc[i])
        out_doc, out_lo, out_hi, known = [], [], [], {}
        for i, passage in enumerate(passages):
            if passage is None or first[passage] < doc[i]:
                # All of it also stands in a smaller document.
                found = [(0, hi[i] - lo[i])]
            else:
                found = known.get(passage)
                if found is None:
                    found, words = [], passage.split(b" ")
                    for end, hit in enumerate(automaton.matches(words, doc[i], window)):
                        if hit:
                            start = end - window + 1
                            if found and found[-1][1] == start - 1:
                                found[-1][1] = start
                            else:
                                found.append([start, start])
                    known[passage] = found
            for a, b in found:
                out_doc.append(doc[i])
                out_lo.append(lo[i] + a)
                out_hi.append(lo[i] + b)
        return pa.table(
            {
                "doc_id": pa.array(out_doc, pa.int64()),
                "lo": pa.array(out_lo, pa.int32()),
                "hi": pa.array(out_hi, pa.int32()),
            }
        )

    return match


def repeated_windows(texts: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """(doc_id, lo, hi): windows that start at words lo .. hi and that a smaller doc_id
    holds too. ``texts`` as for suffix_dedup.repeated_ranges."""
    spark = texts.sparkSession
    path = scratch_path(spark, "shared-runs")
    by_rank = Window.partitionBy("rank")
    (
        texts.mapInArrow(
            _ranked_runs(window, gram), "rank long, doc_id long, lo int, hi int, again boolean"
        )
        .withColumns(
            {"lowest": F.min("doc_id").over(by_rank), "highest": F.max("doc_id").over(by_rank)}
        )
        .filter("again or lowest < highest")
        .select("rank", "doc_id", "lo", "hi", "again")
        .write.parquet(path)
    )
    rows = spark.read.schema("rank long, doc_id long, lo int, hi int, again boolean").parquet(path)
    shared = rows.filter("not again")
    shards = max(_least_shards(spark), shared.count() // SHARD_PASSAGES)
    listed = shared.groupBy("doc_id").agg(
        F.collect_list(F.struct("lo", "hi", "rank")).alias("ranges")
    )
    columns = "rank long, doc_id long, lo int, hi int, passage binary, again boolean"
    matched = (
        texts.join(listed, "doc_id")
        .mapInArrow(_passages(window), columns)
        # Decided passages only pass through: their place spreads them evenly.
        .withColumn("spread", F.when(F.col("again"), F.xxhash64("doc_id", "lo")).otherwise(F.xxhash64("rank")))
        .withColumn("shard", F.pmod("spread", F.lit(shards)))
        .select("shard", "doc_id", "lo", "hi", "passage")
        .groupBy("shard")
        .applyInArrow(_match_shard(window), "doc_id long, lo int, hi int")
    )
    return rows.filter("again").select("doc_id", "lo", "hi").unionByName(matched)


def _least_shards(spark) -> int:
    return 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove_repeated_passages(docs: DataFrame, window: int = 50, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row; ``kept`` are the words.

    Words are what ASCII white space divides, unchanged. Each word covered by a window
    of ``window`` words whose sequence also starts in a document with a smaller doc_id
    goes; windows are judged on the input. The digest is that of the kept words, joined
    by one space. A null text has no words. Rows without doc_id come back whole. Rows
    that repeat a doc_id are one document, as texts_by_id tells. An empty table gives
    no rows.
    """
    texts, torn = texts_by_id(docs)
    ranges = repeated_windows(texts, window, gram)

    def cut(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            out: tuple = ([], [], [], [])
            for i, found in enumerate(range_arrays(batch.column("ranges"))):
                words = data[starts[i] : starts[i + 1]].tobytes().split()
                n = len(words)
                if found is not None:
                    gone = covered(n, *found, window)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                row = (n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode())
                for column, value in zip(out, row):
                    column.append(value)
            columns = [
                batch.column("doc_id"),
                pa.array(out[0], pa.int64()),
                pa.array(out[1], pa.int64()),
                pa.array(out[2], pa.string()),
            ]
            columns.append(pa.array(out[3], pa.string()))
            yield pa.record_batch(
                columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return with_ranges(docs, torn, ranges).mapInArrow(cut, schema)
