"""Vector codes from codebooks learned by dual-tree Lloyd iterations, in integers.

Vectors are cut into equal parts; each part's position has a codebook of entries. For
the parts of a block of vectors a tree of boxes is built at each position, another over
the entries. Pairs of nodes, one of each tree, are followed down: an entry node whose
box is farther from a part node's box than some entry is for certain is pruned for it.
Where a single entry remains, the whole part node is assigned by its cached sums. Parts
in leaves that keep several entries are compared with these in integers. Bounds are
integers too, and equal distances never prune, so every assignment is that of an
exhaustive search, ties to the lower index.

A round reads the vectors once and shuffles the sums of each task's blocks: no more rows
than positions times entries a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.storage import scratch_path

# Vectors for which trees are built at once, and parts in a leaf, about.
BLOCK, LEAF = 8192, 16
# Components are integers within this bound, so that squared distances fit 64 bits.
LARGEST = 1 << 24
# Sums of labels are broadcast up to this number of labels.
MOST_LABELS = 1 << 16


def grid(vectors: pa.Array, scale: int, width: int):
    """(rows, integers): the vectors of ``width`` components without null or non-finite
    ones, as floor(scale * x)."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy()
    flat = vectors.flatten()
    flat = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    lengths = np.maximum(sizes, 0)
    starts = np.cumsum(lengths) - lengths
    rows = np.flatnonzero(sizes == width)
    made = flat[starts[rows][:, None] + np.arange(width)] if len(rows) else np.zeros((0, width))
    finite = np.isfinite(made).all(axis=1)
    made = np.floor(made[finite] * scale)
    if len(made) and np.abs(made).max() > LARGEST:
        raise ValueError(f"components times {scale} have to stay within {LARGEST}")
    return rows[finite], made.astype(np.int64)


class Tree:
    """Boxes over points, as levels that divide them ever more finely.

    ``order`` lists the points; node i of level l has order[cuts[l][i] : cuts[l][i + 1]]
    and the children 2i and 2i + 1. Levels end at about ``leaf`` points a node.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.order, self.cuts = np.arange(n), [np.array([0, n])]
        while n > leaf * (len(self.cuts[-1]) - 1):
            cut = self.cuts[-1]
            own = points[self.order]
            # Each node is halved at the median of its widest side.
            sides = np.maximum.reduceat(own, cut[:-1]) - np.minimum.reduceat(own, cut[:-1])
            node = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            key = own[np.arange(n), sides.argmax(axis=1)[node]]
            self.order = self.order[np.lexsort((key, node))]
            halves = np.empty(2 * len(cut) - 1, np.int64)
            halves[::2], halves[1::2] = cut, (cut[:-1] + cut[1:]) // 2
            if (np.diff(halves) == 0).any():
                break
            self.cuts.append(halves)
        own = points[self.order]
        # Cached sums: those of any node follow from two rows.
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), own.cumsum(axis=0)])
        self.low = [np.minimum.reduceat(own, c[:-1]) for c in self.cuts]
        self.high = [np.maximum.reduceat(own, c[:-1]) for c in self.cuts]


def assign(points: np.ndarray, tree: Tree, entries: np.ndarray, entry_tree: Tree):
    """(nodes, leaves): whole nodes as (lo, hi, entry) arrays over ``tree.order``, and
    (positions in tree.order, entry) of the points that were compared one by one."""
    whole: list = []
    depth, entry_depth = len(tree.cuts) - 1, len(entry_tree.cuts) - 1
    level = entry_level = 0
    # Pairs of a point node and an entry node, ordered by the point node.
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        low, high = tree.low[level][p], tree.high[level][p]
        e_low, e_high = entry_tree.low[entry_level][e], entry_tree.high[entry_level][e]
        apart = np.maximum(np.maximum(e_low - high, low - e_high), 0)
        least = (apart * apart).sum(axis=1)
        reach = np.maximum(e_high - low, high - e_low)
        most = (reach * reach).sum(axis=1)
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        run = np.cumsum(np.append(0, np.diff(p) != 0))
        bound = np.minimum.reduceat(most, first)
        stays = least <= bound[run]
        p, e = p[stays], e[stays]
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        count = np.diff(np.append(first, len(p)))
        if entry_level == entry_depth:
            alone = first[count == 1]
            if len(alone):
                cut, entry = tree.cuts[level], entry_tree.order[e[alone]]
                whole.append((cut[p[alone]], cut[p[alone] + 1], entry))
                left = np.repeat(count > 1, count)
                p, e = p[left], e[left]
            if level == depth or not len(p):
                break
        if level < depth:
            p, e = np.repeat(2 * p, 2) + np.tile([0, 1], len(p)), np.repeat(e, 2)
            level += 1
        if entry_level < entry_depth:
            p, e = np.repeat(p, 2), np.repeat(2 * e, 2) + np.tile([0, 1], len(e))
            entry_level += 1
        order = np.lexsort((e, p))
        p, e = p[order], e[order]
    nodes = tuple(np.concatenate(c) for c in zip(*whole)) if whole else (np.zeros(0, np.int64),) * 3
    # Uncertain leaves: every point with every entry its node has kept.
    cut = tree.cuts[level]
    size = cut[p + 1] - cut[p]
    at = np.repeat(cut[p] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    entry = entry_tree.order[np.repeat(e, size)]
    far = points[tree.order[at]] - entries[entry]
    far = (far * far).sum(axis=1)
    order = np.lexsort((entry, far, at))
    keep = order[np.flatnonzero(np.append(True, at[order][1:] != at[order][:-1]))] if len(at) else order
    return nodes, (at[keep], entry[keep])


class Codebooks:
    """Entries (position, entry, component) with a tree over each position's."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # A node for each entry at the last level. The last entry is repeated up to a power
        # of two; as the lower index wins, its repeats take nothing.
        more = (1 << (entries.shape[1] - 1).bit_length()) - entries.shape[1]
        self.padded = np.concatenate([entries, np.repeat(entries[:, -1:], more, axis=1)], axis=1)
        self.trees = [Tree(own, 1) for own in self.padded]

    def parts(self, vectors: np.ndarray):
        n, (positions, _, width) = len(vectors), self.entries.shape
        return vectors.reshape(n, positions, width).transpose(1, 0, 2)

    def sums(self, vectors: np.ndarray):
        """(sums, counts) of the parts assigned to each entry."""
        sums = np.zeros(self.entries.shape, np.int64)
        counts = np.zeros(self.entries.shape[:2], np.int64)
        for k, own in enumerate(self.parts(vectors)):
            tree = Tree(own, LEAF)
            (lo, hi, entry), (at, single) = assign(own, tree, self.padded[k], self.trees[k])
            np.add.at(sums[k], entry, tree.sums[hi] - tree.sums[lo])
            np.add.at(counts[k], entry, hi - lo)
            np.add.at(sums[k], single, own[tree.order[at]])
            np.add.at(counts[k], single, 1)
        return sums, counts

    def codes(self, vectors: np.ndarray):
        """(codes by vector and position, squared distances summed over positions)."""
        n, positions = len(vectors), len(self.entries)
        codes, error = np.zeros((n, positions), np.int64), np.zeros(n, np.int64)
        for k, own in enumerate(self.parts(vectors)):
            tree = Tree(own, LEAF)
            (lo, hi, entry), (at, single) = assign(own, tree, self.padded[k], self.trees[k])
            size = hi - lo
            places = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            codes[tree.order[places], k] = np.repeat(entry, size)
            codes[tree.order[at], k] = single
            far = own - self.entries[k][codes[:, k]]
            error += (far * far).sum(axis=1)
        return codes, error

    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _usable(vector):
    """Not null, and neither null nor non-finite components."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return vector.isNotNull() & fine


def _first_vectors(rows: DataFrame, size: int) -> list:
    """The vectors of the ``size`` smallest vec_ids, ascending; ties by the vector."""
    known = rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0))
    last = known.select("vec_id").orderBy("vec_id").limit(size).agg(F.max("vec_id")).first()[0]
    if last is None:
        return []
    low = known.filter(F.col("vec_id") <= last).orderBy("vec_id", "vector").limit(size)
    return [r.vector for r in low.select("vector").collect()]


def learn(rows: DataFrame, parts: int, size: int, scale: int, rounds: int) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over rows (vec_id, vector)."""
    first = _first_vectors(rows, size)
    if not first:
        return None
    first = [v for v in first if len(v) == len(first[0])]
    width = len(first[0])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    entries = np.floor(np.array(first, np.float64) * scale)
    if np.abs(entries).max() > LARGEST:
        raise ValueError(f"components times {scale} have to stay within {LARGEST}")
    entries = entries.astype(np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(entries))
    for _ in range(rounds):
        books = Codebooks(_renewed(rows, books, scale, width))
    return books


def _renewed(rows, books, scale, width):
    positions, size, part = books.entries.shape

    def add_up(batches):
        sums = np.zeros(books.entries.shape, np.int64)
        counts = np.zeros((positions, size), np.int64)
        for vectors in _vectors(batches, scale, width):
            more = books.sums(vectors[1])
            sums += more[0]
            counts += more[1]
        used = np.flatnonzero(counts.ravel())
        listed = pa.array(list(sums.reshape(-1, part)[used]), pa.list_(pa.int64()))
        yield pa.record_batch(
            [pa.array(used), pa.array(counts.ravel()[used]), listed], names=["entry", "n", "sums"]
        )

    made = rows.select("vector").mapInArrow(add_up, "entry long, n long, sums array<long>")
    summed = made.groupBy("entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(part))
    )
    # No more rows than the codebooks have entries.
    entries = books.entries.reshape(-1, part).copy()
    for row in summed.collect():
        entries[row[0]] = [total // row[1] for total in row[2:]]
    return entries.reshape(books.entries.shape)


def _vectors(batches, scale, width):
    """(rows in the batch's part, integers, that part) block by block."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            rows, vectors = grid(part.column(part.num_columns - 1), scale, width)
            if len(rows) or part.num_columns > 1:
                yield rows, vectors, part


def vector_codes(
    embeddings: DataFrame, parts: int = 16, size: int = 64, scale: int = 256, rounds: int = 2
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row.

    A component x counts as the integer floor(scale * x). The codebooks start as the
    parts of the ``size`` smallest vec_ids (ties: by the vectors; fewer rows: fewer
    entries). ``code`` has the index of the nearest entry for each part, two hex digits
    each, ``error`` the squared distances summed over the parts, ``label_error`` its sum
    over the rows of an equal label, those without label together.

    Left out are rows whose vector is null or has null or non-finite components. Rows
    whose vector is not as long as the first in the codebooks have null code and error
    and add nothing. Repeated rows count each for itself. Rows without vec_id are coded
    but never start a codebook; if none has one, codes are null. An empty table gives no
    rows. Vectors whose length the parts do not divide, or with components beyond
    2^24 / scale, are refused with a ValueError. Only vec_id, label and embedding are read.
    """
    if not 1 <= size <= 256:
        raise ValueError("two hex digits number 256 entries")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector")
    ).filter(_usable(F.col("embedding")))
    books = learn(rows.select("vec_id", "vector"), parts, size, scale, rounds)
    if books is None:
        nothing = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
        return rows.select(
            "vec_id", "label", *nothing, F.lit(None).cast("long").alias("label_error"),
            F.lit(hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"),
        )
    width = books.entries.shape[0] * books.entries.shape[2]
    label_type = dict(rows.dtypes)["label"]

    def code(batches):
        for at, vectors, part in _vectors(batches, scale, width):
            codes, errors = np.full(part.num_rows, None, object), np.zeros(part.num_rows, np.int64)
            absent = np.ones(part.num_rows, bool)
            if len(at):
                found, errors[at] = books.codes(vectors)
                codes[at] = [row.tobytes().hex() for row in found.astype(np.uint8)]
                absent[at] = False
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array(codes, pa.string()), pa.array(errors, mask=absent)],
                names=["vec_id", "label", "code", "error"],
            )

    # Stored, as sums and rows are both taken from it.
    path, types = scratch_path(rows.sparkSession, "codes"), f"vec_id long, label {label_type}, code string, error long"
    rows.mapInArrow(code, types).write.parquet(path)
    coded = rows.sparkSession.read.schema(types).parquet(path)
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    few = coded.select("label").distinct().limit(MOST_LABELS + 1).count() <= MOST_LABELS
    # Beyond that, adaptive execution divides the rows of a hot label in the join.
    sums = F.broadcast(sums) if few else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
