"""Token counts without token ids.

Byte-level BPE never merges across pre-tokens, so a text's count is the sum over its
pre-tokens. Pieces are counted once per distinct pre-token of the corpus. Documents
become (pre-token, frequency) rows, which are joined to those counts and summed.

Frequent pre-tokens would be the join's hot keys. The head, a fixed number of the most
frequent ones with a fixed longest length, is broadcast, and documents add its share
up while they are read; what goes through the join is the tail.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from verbatide.storage import scratch_path

# Fixed value: how byte-level BPE of this family divides a text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Both bound the broadcast: at most HEAD_SIZE keys of at most HEAD_BYTES bytes.
HEAD_SIZE = 1 << 18
HEAD_BYTES = 24
# Steps of frequency to a doubling, at one of which the head ends.
HEAD_STEPS = 16

# Beyond these characters, Unicode tables and notions of white space may differ
# between libraries; such texts are divided by the tokenizer itself.
_UNSURE = regex.compile("[^\t\n\r -~\xa0-\u017f\u2010-\u201f\u2026\u20ac]")
_split = regex.compile(PRE_TOKEN).findall

_loaded: dict = {}


class Counting:
    """A tokenizer of one worker, with its added tokens apart."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        marks = sorted({str(token.content) for token in added}, key=lambda s: (-len(s), s))
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens outside added tokens, and the number of added tokens."""
        parts = [text]
        if self.marks is not None and self.marks.search(text):
            parts = self.marks.split(text)
        found: list[str] = []
        for part in parts:
            if not part:
                continue
            if _UNSURE.search(part):
                pairs = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                found.extend(part[start:end] for _, (start, end) in _whole(pairs))
            else:
                found.extend(_split(part))
        return found, len(parts) - 1

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        encoded = self.tokenizer.encode_batch(pre_tokens, add_special_tokens=False)
        return [len(e) for e in encoded]


def _whole(pairs):
    return [pair for pair in pairs if pair[1][0] < pair[1][1]]


def counting(path: str) -> Counting:
    if path not in _loaded:
        _loaded[path] = Counting(path)
    return _loaded[path]


_COUNTED = pa.schema([("token", pa.string()), ("n", pa.int64())])
_READ = pa.schema(
    [
        ("place", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("head_tokens", pa.int64()),
        ("token", pa.string()),
        ("n", pa.int64()),
    ]
)
# Rows that a task gathers before it hands them on.
_ROWS = 200_000


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, also with one
    doc_id or none, are counted each for itself. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def distinct(batches):
        """Each task's pre-tokens with their counts, summed before the shuffle."""
        counter = counting(tokenizer_path)
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                if (value := text.as_py()) is not None:
                    counts.update(counter.pre_tokens(value)[0])
                    if len(counts) > _ROWS * 2:
                        yield _arrow([list(counts), list(counts.values())], _COUNTED)
                        counts.clear()
        yield _arrow([list(counts), list(counts.values())], _COUNTED)

    def pieces(batches):
        counter = counting(tokenizer_path)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            sizes = []
            for start in range(0, len(tokens), 1000):
                sizes += counter.pieces(tokens[start : start + 1000])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())],
                ["token", "n", "pieces"],
            )

    vocabulary = scratch_path(spark, "pieces")
    (
        texts.select("text")
        .mapInArrow(distinct, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .mapInArrow(pieces, "token string, n long, pieces long")
        .write.parquet(vocabulary)
    )
    counted = spark.read.schema("token string, n long, pieces long").parquet(vocabulary)
    short = counted.filter(F.octet_length("token") <= HEAD_BYTES)
    step = F.floor(F.log2("n") * HEAD_STEPS)
    # At most 63 * HEAD_STEPS rows. The head ends where the next step would pass its size.
    least, held = None, 0
    for at, size in sorted(short.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += size
        if held > HEAD_SIZE:
            break
        least = at
    head_rows = short.filter(step >= least) if least is not None else short.limit(0)
    frequent = head_rows.select("token", "pieces").toArrow()
    head = spark.sparkContext.broadcast(
        dict(zip(frequent.column(0).to_pylist(), frequent.column(1).to_pylist()))
    )

    def read(batches):
        counter, known = counting(tokenizer_path), head.value
        place = TaskContext.get().partitionId() << 40
        rows: tuple = ([], [], [], [], [], [])
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = text.as_py() or ""
                found, total = counter.pre_tokens(value)
                tail = []
                for token, n in Counter(found).items():
                    size = known.get(token)
                    if size is None:
                        tail.append((token, n))
                    else:
                        total += size * n
                place += 1
                _add(rows, place, doc, len(value.encode()), total, None, None)
                for token, n in tail:
                    _add(rows, place, None, None, None, token, n)
                if len(rows[0]) > _ROWS:
                    yield _arrow(rows, _READ)
                    for column in rows:
                        column.clear()
        yield _arrow(rows, _READ)

    frequencies = texts.mapInArrow(
        read,
        "place long, doc_id long, n_bytes long, head_tokens long, token string, n long",
    )
    # Rows of the documents themselves have no token; their place spreads them instead.
    keyed = frequencies.withColumn("is_tail", F.col("token").isNotNull()).withColumn(
        "token", F.coalesce("token", F.col("place").cast("string"))
    )
    sizes = counted.select("token", "pieces", F.lit(True).alias("is_tail"))
    return (
        keyed.join(sizes, ["token", "is_tail"], "left")
        .groupBy("place")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(
                F.coalesce("head_tokens", F.lit(0)) + F.coalesce(F.col("n") * F.col("pieces"), F.lit(0))
            ).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def _arrow(columns, schema):
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _add(rows, *values):
    for column, value in zip(rows, values):
        column.append(value)
