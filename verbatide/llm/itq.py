"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of rotated vectors, less
their label's mean, make balanced codes that lose little (iterative quantisation).
Codes are cut into substrings, one table for each; vectors that share a label and a
substring meet in a bucket, and are compared there with their original vectors.

The angle at the threshold gives the chance that a bit differs, hence the number of
tables that finds a pair with a wanted probability. Less the mean, vectors that crowd
around it stand at wider angles: tables are planned for the shortest of what is left of
them, and where that is too short, such vectors go to tables of uncentred codes too. Substrings get longer with the
largest label, so that buckets stay of a size; if one rotation has not enough bits,
further ones are learned from other starts.

A bucket beyond a block's size is dealt into blocks, and each pair of blocks is a
group of its own. Groups hand on counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.components import connected_components
from verbatide.llm.sampling import share_by_hash
from verbatide.llm.simhash_vptree import Forest
from verbatide.storage import cut_lineage

# The sample bounds what the driver reads for the fit; every vector is indexed.
SAMPLE, ROUNDS = 8192, 40
# A bucket's aim, a block's size, the chance to miss a pair at the threshold, rows a task.
BUCKET, BLOCK, MISS, TASK_ROWS = 64, 512, 1e-3, 4096
# Vectors shorter than this, less their label's mean, are not looked for by centred codes.
SHORT = 0.75


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Iterative quantisation: a (dim, bits) projection, principal axes then a rotation."""
    dim = sample.shape[1]
    bits = min(dim, 64)
    if len(sample):
        _, axes = np.linalg.eigh(sample.T @ sample)
    else:
        axes = np.eye(dim)
    axes = axes[:, ::-1][:, :bits]
    flat = sample @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds if len(sample) else 0):
        codes = np.where(flat @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(codes.T @ flat)
        turn = (u @ v).T
    return axes @ turn


def table_plan(largest: int, threshold: float) -> tuple[int, int]:
    """(bits of a substring, tables) for the largest label and the cosine threshold."""
    bits = max(8, min(24, math.ceil(math.log2(max(largest, 1) / BUCKET))))
    same = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    if same >= 1:
        return bits, 1
    return bits, max(1, math.ceil(math.log(MISS) / math.log(1 - same)))


def centred_plan(largest: int, threshold: float, least: float) -> tuple[int, int, float]:
    """(bits, tables, shortest) for vectors less their mean, of ``least`` length or more.

    At lengths a, b >= shortest, a pair at the threshold has a cosine of no less than
    1 - (1 - threshold) / shortest ** 2. Shortest is ``least`` if that takes no more than
    twice the tables of whole vectors, else SHORT, else beyond all, with no tables; what
    is shorter has to be found by uncentred codes."""
    bits, plain = table_plan(largest, threshold)
    for shortest in (least, max(least, SHORT)):
        cosine = 1 - (1 - threshold) / shortest**2 if shortest > 0 else -1.0
        if cosine > -0.99:
            tables = table_plan(largest, cosine)[1]
            if tables <= 2 * plain:
                return bits, tables, shortest
    return bits, 0, math.inf


def even_projection(dim: int, seed: int) -> np.ndarray:
    """A random (dim, bits) projection with orthogonal columns."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(dim, 64))))[0]


def substrings(vectors: np.ndarray, projections: list, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) substrings of the codes, as ints."""
    if not tables:
        return np.zeros((len(vectors), 0), np.int64)
    signs = np.concatenate([vectors @ p >= 0 for p in projections], axis=1)[:, : bits * tables]
    weights = 1 << np.arange(bits)
    return signs.reshape(len(vectors), tables, bits) @ weights


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as doubles; zeros follow shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    for row, part in zip(out, np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else ()):
        row[: len(part)] = part
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one; by the largest first, so that squares neither overflow nor
    vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def embedding_duplicates(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector.

    Vectors are linked if their labels are equal and their cosine, in doubles, is at
    least the threshold. A vector that is null, empty, zero or holds a null or a
    non-finite component, or whose label is null, links with nothing; one that is
    shorter than others counts as if zeros followed. Rows that repeat a vec_id are one
    vector, the least by (label, embedding). Rows without vec_id come back with no
    links, no component and kept. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    every = embeddings.select("vec_id", "label", "embedding")
    nameless = every.filter(F.col("vec_id").isNull())
    vectors = cut_lineage(
        every.filter(F.col("vec_id").isNotNull())
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "embedding")).alias("v"))
        .select("vec_id", "v.label", "v.embedding")
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    usable = vectors.filter(
        F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    types = dict(vectors.dtypes)
    sizes = usable.groupBy("label").agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")
    )
    largest, dim, number = sizes.agg(F.max("n"), F.max("dim"), F.sum("n")).first()
    largest, dim, number = largest or 0, dim or 1, number or 0

    def scale(batches):
        for batch in batches:
            rows = _unit(_matrix(batch.column("embedding"), dim))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), dim)
            yield pa.record_batch(
                [batch.column("label"), listed.cast(pa.list_(pa.float64()))], names=["label", "unit"]
            )

    entries = (
        usable.select("label", "embedding")
        .mapInArrow(scale, f"label {types['label']}, unit array<double>")
        .select("label", F.posexplode("unit").alias("at", "x"))
    )
    means = cut_lineage(
        entries.groupBy("label", "at")
        .agg(F.avg("x").alias("mean"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("m"))
        .select("label", F.col("m.mean").alias("mean"))
    )
    centred = usable.join(means, "label")

    def lengths(batches):
        for batch in batches:
            rows = _unit(_matrix(batch.column("embedding"), dim))
            rows -= _matrix(batch.column("mean"), dim)
            yield pa.record_batch([pa.array(np.sqrt((rows * rows).sum(axis=1)))], names=["r"])

    left = centred.select("embedding", "mean").mapInArrow(lengths, "r double")
    least, least_long = left.agg(
        F.min("r"), F.min(F.when(F.col("r") >= SHORT, F.col("r")))
    ).first()
    least = 1.0 if least is None else least
    bits, tables, shortest = centred_plan(largest, threshold, least)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    whole = 0
    if least < shortest:
        # Nothing lies between SHORT and the shortest of the long ones.
        if least_long is not None:
            bits, tables, shortest = centred_plan(largest, threshold, least_long)
        else:
            tables, shortest = 0, math.inf
        whole = table_plan(largest, threshold)[1]
    drawn = share_by_hash(usable, "vec_id", SAMPLE, number).join(means, "label")
    drawn = drawn.select("embedding", "mean").toArrow()
    sample = _unit(_matrix(drawn.column("embedding"), dim)) - _matrix(drawn.column("mean"), dim)
    per_rotation = min(dim, 64)
    projections = [
        learn_rotation(sample, seed) for seed in range(math.ceil(bits * tables / per_rotation))
    ]
    uncentred = [
        even_projection(dim, seed) for seed in range(math.ceil(bits * whole / per_rotation))
    ]

    def index(batches):
        """A row for each vector and table that it is in, with all of the vector's
        substrings; -1 where it is not."""
        for batch in batches:
            rows = _unit(_matrix(batch.column("embedding"), dim))
            less = rows - _matrix(batch.column("mean"), dim)
            codes = substrings(less, projections, bits, tables)
            if whole:
                length = np.sqrt((less * less).sum(axis=1))
                codes[length < shortest] = -1
                # The other end of a short vector's link is longer by no more than reach.
                further = substrings(rows, uncentred, bits, whole)
                further[length >= shortest + reach] = -1
                codes = np.concatenate([codes, further], axis=1)
            listed = pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32()))
            for t in range(codes.shape[1]):
                every = pa.record_batch(
                    [
                        batch.column("label"),
                        pa.array(np.full(len(rows), t, np.int32)),
                        pa.array(codes[:, t].astype(np.int32)),
                        batch.column("vec_id"),
                        listed,
                        batch.column("embedding"),
                    ],
                    names=["label", "t", "key", "vec_id", "codes", "embedding"],
                )
                yield every.filter(pa.array(codes[:, t] >= 0)) if whole else every

    indexed = centred.mapInArrow(
        index,
        f"label {types['label']}, t int, key int, vec_id {types['vec_id']}, codes array<int>, "
        f"embedding {types['embedding']}",
    )
    buckets = cut_lineage(
        indexed.groupBy("label", "t", "key")
        .count()
        .select("label", "t", "key", "count", F.ceil(F.col("count") / BLOCK).alias("blocks"))
    )
    crowded = buckets.filter(F.col("blocks") > 1).drop("count")
    dealt_rows = buckets.agg(F.sum(F.col("count") * F.col("blocks"))).first()[0] or 0
    shards = shard_number(dealt_rows, _tasks(spark))
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    dealt = (
        indexed.join(crowded, ["label", "t", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("group", F.xxhash64("label", "t", "key", "low", "high"))
        .withColumn("second", (F.col("own") == F.col("high")) & (F.col("low") < F.col("high")))
        .withColumn("crossed", F.col("low") < F.col("high"))
        .withColumn("shard", F.pmod("group", F.lit(shards)).cast("int"))
        .select("shard", "label", "group", "t", "key", "crossed", "second", "vec_id", "codes", "embedding")
    )

    def compare(table):
        return _links(table, dim, threshold)

    found = cut_lineage(
        dealt.groupBy("shard").applyInArrow(
            compare, f"vec_id {types['vec_id']}, n long, other {types['vec_id']}"
        )
    )
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    edges = found.filter(F.col("other").isNotNull()).select("vec_id", "other")
    roots = connected_components(edges, "vec_id", "other").withColumnRenamed("node", "vec_id")
    smallest = roots.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    classes = roots.join(smallest, "root").select("vec_id", "component_id")
    return (
        vectors.select("vec_id")
        .join(counts, "vec_id", "left")
        .join(classes, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
        .unionByName(
            nameless.select(
                "vec_id",
                F.lit(0).cast("long").alias("n_links"),
                F.col("vec_id").alias("component_id"),
                F.lit(True).alias("kept"),
            )
        )
    )


def shard_number(dealt_rows: int, least: int) -> int:
    """Shards of about TASK_ROWS of the rows that buckets are dealt into, all labels'."""
    return max(12, math.ceil(dealt_rows / TASK_ROWS), least)


def _tasks(spark) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _links(table: pa.Table, dim: int, threshold: float) -> pa.Table:
    """Counts and a spanning forest of the links within a shard's groups.

    A pair that shares several substrings counts in the first such table only.
    """
    # In order of vec_id, so that stars of links are around the smallest.
    table = table.sort_by("vec_id").combine_chunks()
    n = table.num_rows
    vectors = _unit(_matrix(table.column("embedding"), dim))
    codes = np.array(table.column("codes").combine_chunks().flatten()).reshape(n, -1)
    ids = table.column("vec_id")
    group = table.column("group").to_numpy()
    t = table.column("t").to_numpy()
    key = table.column("key").to_numpy()
    label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    second = table.column("second").to_numpy(zero_copy_only=False)
    crossed = table.column("crossed").to_numpy(zero_copy_only=False)
    order = np.lexsort((second, key, label, t, group))
    edge = np.flatnonzero(np.diff(group[order])) + 1
    counts = np.zeros(n, np.int64)
    forest = Forest(n)
    for own in np.split(order, edge):
        if len(own) < 2:
            continue
        a, b = (own[~second[own]], own[second[own]]) if crossed[own[0]] else (own, own)
        for start in range(0, len(a), BLOCK):
            some = a[start : start + BLOCK]
            near = vectors[some] @ vectors[b].T >= threshold
            # Groups are named by a hash: their keys are compared as well.
            near &= (label[some][:, None] == label[b]) & (key[some][:, None] == key[b])
            near &= t[some][:, None] == t[b]
            x, y = np.nonzero(near)
            x, y = some[x], b[y]
            at = t[x][:, None] > np.arange(codes.shape[1])
            same = (codes[x] == codes[y]) & (codes[x] >= 0)
            fresh = (x != y) & ~(same & at).any(axis=1)
            x, y = x[fresh], y[fresh]
            counts += np.bincount(x, minlength=n)
            if crossed[own[0]]:
                counts += np.bincount(y, minlength=n)
            forest.add(x, y)
    linked = np.flatnonzero(counts)
    child, parent = forest.links()
    return pa.table(
        {
            "vec_id": pa.concat_arrays([_take(ids, linked), _take(ids, child)]),
            "n": pa.array(np.concatenate([counts[linked], np.zeros(len(child), np.int64)])),
            "other": pa.concat_arrays([pa.nulls(len(linked), ids.type), _take(ids, parent)]),
        }
    )


def _take(column, at):
    taken = column.take(pa.array(at))
    return taken.combine_chunks() if isinstance(taken, pa.ChunkedArray) else taken
