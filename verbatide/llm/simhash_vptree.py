"""SimHash near-duplicates, found through vantage-point trees.

Fingerprints lie in the metric space of Hamming distances. The upper levels of a
vantage-point tree, built on a bounded sample, divide them into shards: at each node a
fingerprint goes inside or outside the median distance from a vantage point. By the
triangle inequality, whatever is within the radius of a fingerprint lies on a side
whose bounds the radius reaches, so a fingerprint is also sent, as a query, to every
other shard that its ball overlaps. Each shard builds the lower levels over its members
and answers its queries by the same bound; pairs that remain are compared exactly.

All comparisons are between distinct fingerprints, so exact copies cost nothing, and a
shard hands on a spanning forest of its links instead of all pairs of a dense group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.components import connected_components
from verbatide.llm.sampling import share_by_hash
from verbatide.llm.windows import mix
from verbatide.storage import cut_lineage

# A shard's aim, the least number of shards (work for many tasks), and the largest
# (bounds the tree in each task: 24 bytes a node). The sample bounds what the driver sees.
SHARD, LEAST_SHARDS, MOST_SHARDS = 16_384, 32, 8192
SAMPLE_PER_SHARD, LEAF = 32, 64
# Members and queries of a shard that meet in one group, and cells of a matrix of distances.
MEMBER_BLOCK, QUERY_BLOCK, CELLS = 2 * SHARD, 8 * SHARD, 1 << 20
# A block of sets to compare, in shingles, and what a set counts besides its own.
SET_BLOCK, SET_COST = 1 << 20, 256
# Candidates for similar sets beyond the radius share one of BANDS groups of ROWS least hashes: a pair whose
# similarity is 0.8 does with a chance of 1 - (1 - 0.8 ** 6) ** 18 = 0.996.
BANDS, ROWS = 18, 6

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LANES = np.uint64(0x0101010101010101)
_ANEW = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes).tolist()
    ends = ends[words - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends)], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes. None: zero."""
    n = len(hashes)
    counts = np.zeros((8, 8), np.int64)
    blocks = np.arange(0, n, 255)
    for bit in range(8 if n else 0):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, blocks)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts.ravel() * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, words: int = 4, seed: int = 42, wide: int = 0, distinct: bool = False
) -> DataFrame:
    """(doc_id, fp, more) for every row; fp is the 64-bit fingerprint as a signed long,
    and ``more`` has ``wide`` further ones, from the same hashes mixed anew. With
    ``distinct``, a repeated shingle counts once, ``node`` names the set of them, and
    ``bands`` has its keys of least hashes (none for the empty set).

    A-Z are lower-cased; words are what ASCII white space divides. A text with fewer
    words than a shingle has one shingle, all of them; null and blank texts have
    fingerprint zero.
    """

    def read(batches):
        mixers = _mixers()
        for batch in batches:
            prints, more, named, bands = [], [], [], []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), words, seed)
                if distinct:
                    hashes = np.unique(hashes)
                    named.append(set_name(hashes))
                    bands.append(band_keys(hashes, mixers) if len(hashes) else [])
                prints.append(simhash(hashes))
                for _ in range(wide):
                    hashes = mix(hashes + _ANEW)
                    more.append(simhash(hashes))
            ends = pa.array(np.arange(len(prints) + 1, dtype=np.int32) * wide)
            further = pa.array(np.array(more, np.uint64).view(np.int64))
            columns = {
                "doc_id": batch.column(0),
                "fp": pa.array(np.array(prints, np.uint64).view(np.int64)),
                "more": pa.ListArray.from_arrays(ends, further),
            }
            if distinct:
                columns["node"] = pa.array(np.array(named, np.uint64).view(np.int64))
                keys = pa.array(np.array([k for own in bands for k in own], np.uint64).view(np.int64))
                ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
                columns["bands"] = pa.ListArray.from_arrays(pa.array(ends), keys)
            yield pa.record_batch(list(columns.values()), names=list(columns))

    ids = F.col("doc_id").cast("long").alias("doc_id")
    types = "doc_id long, fp long, more array<long>" + (", node long, bands array<long>" if distinct else "")
    return docs.select(ids, "text").mapInArrow(read, types)


def _mixers():
    """An odd factor and an offset for each least hash."""
    draw = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _ANEW)
    return [(a | np.uint64(1), b) for a, b in draw.reshape(-1, 2)]


def band_keys(hashes: np.ndarray, mixers) -> list[int]:
    """A key for each band of least hashes of a set, which is not empty."""
    least = np.array([((hashes ^ b) * a).min() for a, b in mixers], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    return [digest(part.tobytes(), i) for i, part in enumerate(least.reshape(BANDS, ROWS))]


def set_name(hashes: np.ndarray) -> int:
    """One number for a sorted set of hashes."""
    return xxhash.xxh64_intdigest(hashes.tobytes())


def shingle_sets(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(node, shingles): each row's distinct shingles in order, and their name."""

    def read(batches):
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), words, seed)) for t in batch.column(0)]
            # As many sets as make up a part of bounded size, and one at least.
            at = 0
            while at < len(sets):
                end, held = at + 1, len(sets[at])
                while end < len(sets) and held + len(sets[end]) <= 1 << 20:
                    held += len(sets[end])
                    end += 1
                some = sets[at:end]
                ends = pa.array(np.cumsum([0, *map(len, some)]).astype(np.int32))
                flat = pa.array(np.concatenate(some).view(np.int64))
                named = np.array([set_name(x) for x in some], np.uint64).view(np.int64)
                yield pa.record_batch(
                    [pa.array(named), pa.ListArray.from_arrays(ends, flat)],
                    names=["node", "shingles"],
                )
                at = end

    return docs.select("text").mapInArrow(read, "node long, shingles array<long>")


def distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(points: np.ndarray, leaves: int) -> list:
    """Nodes (vantage point, median distance), in heap order: the children of i are
    2i + 1 (within the median) and 2i + 2 (beyond it). ``leaves`` is a power of two."""
    nodes: list = [None] * (leaves - 1)
    waiting = [(0, points)]
    while waiting:
        at, own = waiting.pop()
        if at >= len(nodes):
            continue
        # The point among a few whose distances divide the others most evenly.
        best = (np.uint64(0), 32, 2.0)
        for candidate in own[:: max(1, len(own) // 8)][:8]:
            far = distance(own, candidate)
            median = int(np.median(far))
            uneven = abs(float((far <= median).mean()) - 0.5) - float(far.std()) / 64
            if uneven < best[2]:
                best = (candidate, median, uneven)
        nodes[at] = best[:2]
        near = distance(own, best[0]) <= best[1] if len(own) else np.zeros(0, bool)
        waiting += [(2 * at + 1, own[near]), (2 * at + 2, own[~near])]
    return nodes


def reached(nodes: list, points: np.ndarray, radius: int):
    """(leaf, indices of points whose ball overlaps it) for every leaf."""
    waiting = [(0, np.arange(len(points)))]
    while waiting:
        at, own = waiting.pop()
        if at >= len(nodes):
            yield at - len(nodes), own
            continue
        vantage, median = nodes[at]
        far = distance(points[own], vantage).astype(np.int64)
        waiting.append((2 * at + 1, own[far - radius <= median]))
        waiting.append((2 * at + 2, own[far + radius > median]))


class Forest:
    """Union by smallest index; links that join nothing new are dropped."""

    def __init__(self, n):
        self.parent = np.arange(n)

    def add(self, a, b):
        parent = self.parent
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([a[apart], b[apart]], 1), axis=0)
        for x, y in pairs.tolist():
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)

    def links(self):
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        child = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return child, self.parent[child]


def search_shard(
    points: np.ndarray, member: np.ndarray, radius: int, more=None, total=None, asks=None
):
    """Links from the points that ask (by default all) to a shard's members, as a
    spanning forest of stars around the points that come first. With ``total``, the
    distance over the points and their rows of ``more`` has to keep to that as well."""
    members, at = points[member], np.flatnonzero(member)
    forest = Forest(len(points))
    leaves = 1
    while leaves * LEAF < len(members):
        leaves *= 2
    nodes = build_tree(members, leaves)
    inside = dict(reached(nodes, members, 0))
    asking = np.arange(len(points)) if asks is None else np.flatnonzero(asks)
    for leaf, own in reached(nodes, points[asking], radius):
        held, own = inside[leaf], asking[own]
        step = max(1, CELLS // max(1, len(held)))
        for start in range(0, len(own), step):
            some = own[start : start + step]
            q, m = np.nonzero(distance(points[some][:, None], members[held][None, :]) <= radius)
            q, m = some[q], at[held[m]]
            if total is not None:
                whole = distance(points[q], points[m]).astype(np.int64)
                whole += distance(more[q], more[m]).sum(axis=1, dtype=np.int64)
                q, m = q[whole <= total], m[whole <= total]
            forest.add(q, m)
    return forest.links()


def fingerprint_links(prints: DataFrame, radius: int = 4, total: int | None = None) -> DataFrame:
    """(a, b): links that connect what is within the radius, from distinct fingerprints
    (node, fp, more). With ``total``, distances over fp and more keep to that as well.

    The pairs form a spanning forest per group: their components are exactly those of
    all pairs of distinct fingerprints at ``radius`` or fewer differing bits. A group is
    a block of a shard's members and a block of what asks there, so that none grows with
    the table, whatever the number of shards.
    """
    number = prints.count()
    shards = LEAST_SHARDS
    while shards * SHARD < number and shards < MOST_SHARDS:
        shards *= 2
    drawn = share_by_hash(prints, "node", shards * SAMPLE_PER_SHARD, number)
    sample = drawn.select("fp").toArrow().column(0).to_numpy().view(np.uint64)
    nodes = build_tree(sample, shards)

    def route(batches):
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            home = np.zeros(len(points), np.int64)
            for leaf, own in reached(nodes, points, 0):
                home[own] = leaf
            for leaf, own in reached(nodes, points, radius):
                # Two fingerprints within the radius reach each other's shards; one way is
                # enough, which a hash of both leaves chooses.
                at = home[own]
                pair = np.minimum(at, leaf) * MOST_SHARDS + np.maximum(at, leaf)
                down = (mix(pair.astype(np.uint64) + _ANEW) & np.uint64(1)).astype(bool)
                own = own[(at == leaf) | ((at > leaf) == down)]
                if len(own):
                    sent = batch.take(pa.array(own))
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(own), leaf, np.int32)),
                            *sent.columns,
                            pa.array(home[own] == leaf),
                        ],
                        names=["shard", *sent.schema.names, "member"],
                    )

    def search(table):
        table = table.sort_by("node").combine_chunks()
        nodes = table.column("node").to_numpy()
        points = table.column("fp").to_numpy().view(np.uint64)
        member = table.column("member").to_numpy(zero_copy_only=False)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        more = table.column("more").combine_chunks().flatten().to_numpy().view(np.uint64)
        child, parent = search_shard(
            points, member, radius, more.reshape(len(points), -1), total, asks
        )
        return pa.table({"a": pa.array(nodes[child]), "b": pa.array(nodes[parent])})

    routed = prints.select("node", "fp", "more").mapInArrow(
        route, "shard int, node long, fp long, more array<long>, member boolean"
    )
    # One row per shard, MOST_SHARDS at the most.
    blocks = cut_lineage(
        routed.groupBy("shard")
        .agg(F.count_if("member").alias("members"), F.count("*").alias("rows"))
        .select(
            "shard",
            F.greatest(F.lit(1), F.ceil(F.col("members") / MEMBER_BLOCK)).alias("m_blocks"),
            F.ceil(F.col("rows") / QUERY_BLOCK).alias("q_blocks"),
        )
    )
    m, q = F.pmod(F.xxhash64("node"), "m_blocks"), F.pmod(F.xxhash64(F.lit(1), "node"), "q_blocks")
    asked = F.transform(
        F.sequence(F.lit(0), F.col("m_blocks") - 1), lambda i: F.struct(i.alias("m"), F.col("q").alias("q"))
    )
    answers = F.transform(
        F.sequence(F.lit(0), F.col("q_blocks") - 1), lambda i: F.struct(F.col("m").alias("m"), i.alias("q"))
    )
    dealt = (
        routed.join(F.broadcast(blocks), "shard")
        .withColumns({"m": m, "q": q})
        .withColumn("cell", F.explode(F.when(F.col("member"), F.array_union(asked, answers)).otherwise(asked)))
        .select(
            "shard", "cell.m", "cell.q", "node", "fp", "more",
            (F.col("member") & (F.col("cell.m") == F.col("m"))).alias("member"),
            (F.col("cell.q") == F.col("q")).alias("asks"),
        )
    )
    return dealt.groupBy("shard", "m", "q").applyInArrow(search, "a long, b long")


def similar_sets(flat, ends, prints, sides, similarity: float, total: int):
    """(child, parent): a spanning forest of the links among sets ``flat[ends[i] :
    ends[i + 1]]`` whose Jaccard similarity is at least ``similarity``, out of those
    whose rows of ``prints`` differ in ``total`` bits or fewer. If ``sides`` has two
    values, only sets of different sides are compared."""
    n, sizes = len(ends) - 1, np.diff(ends)
    _, code = np.unique(flat, return_inverse=True)
    held = np.zeros(len(flat), bool)
    forest, both = Forest(n), len(np.unique(sides)) > 1
    for i in range(n - 1):
        others = np.arange(i + 1, n)
        # What is already joined needs no comparison; components are all that counts.
        others = others[forest.parent[others] != forest.parent[i]]
        if both:
            others = others[sides[others] != sides[i]]
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[small >= similarity * large - 1]
        far = distance(prints[others], prints[i]).sum(axis=1, dtype=np.int64)
        others = others[far <= total]
        if not len(others):
            continue
        own = code[ends[i] : ends[i + 1]]
        held[own] = True
        common = np.array([held[code[ends[j] : ends[j + 1]]].sum() for j in others])
        held[own] = False
        union = sizes[i] + sizes[others] - common
        close = others[(union > 0) & (common / np.maximum(union, 1) >= similarity)]
        if len(close):
            forest.add(np.full(len(close), i), close)
            while not np.array_equal(up := forest.parent[forest.parent], forest.parent):
                forest.parent = up
    return forest.links()


def candidate_links(prints: DataFrame) -> DataFrame:
    """(a, b): every node (node, bands) with the least node that shares a band with it.

    Components of these links hold whatever shares a band. A crowded band is one link
    a node, and adaptive execution divides its rows in the join.
    """
    keyed = prints.select("node", F.explode("bands").alias("band"))
    first = (
        keyed.groupBy("band")
        .agg(F.min("node").alias("a"), F.max("node").alias("last"))
        .filter(F.col("a") < F.col("last"))
        .select("band", "a")
    )
    linked = keyed.join(first, "band").filter(F.col("node") != F.col("a"))
    return linked.select("a", F.col("node").alias("b")).distinct()


def confirmed_links(
    docs: DataFrame, prints: DataFrame, loose: DataFrame, words: int, seed: int,
    similarity: float, total: int,
) -> DataFrame:
    """(a, b): links between nodes of one loose component (node, root) whose sets of
    shingles have at least the wanted Jaccard similarity. ``prints`` (node, fp, more,
    first) has a doc_id of each node.

    A component beyond a block's size is dealt into blocks, and each pair of blocks is
    a group of its own, so that no group grows with its component.
    """
    candidates = prints.join(loose, "node")
    # Only texts that may be linked are read again; which one of a node's is all the same.
    wanted = candidates.select(F.col("first").alias("_wanted")).distinct()
    docs = docs.select("doc_id", "text")
    some = docs.join(wanted, F.col("doc_id").cast("long").eqNullSafe(F.col("_wanted")), "left_semi")
    sets = (
        shingle_sets(some, words, seed)
        .dropDuplicates(["node"])
        .join(candidates.select("node", "fp", "more", "root"), "node")
    )
    # Only sets of linked texts, once each: read for the sizes, then for the blocks.
    sets = cut_lineage(sets.withColumn("weight", F.size("shingles") + SET_COST))
    blocks = (
        sets.groupBy("root")
        .agg(F.sum("weight").alias("weight"))
        .select("root", F.ceil(F.col("weight") / SET_BLOCK).alias("blocks"))
    )
    dealt = (
        sets.drop("weight")
        .join(blocks, "root")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .select("root", "low", "high", "own", "node", "fp", "more", "shingles")
    )

    def confirm(table):
        table = table.sort_by("node").combine_chunks()
        n, nodes = table.num_rows, table.column("node").to_numpy()
        listed = table.column("shingles").combine_chunks()
        listed = listed.combine_chunks() if isinstance(listed, pa.ChunkedArray) else listed
        sizes = listed.value_lengths().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        fp = table.column("fp").to_numpy().view(np.uint64).reshape(n, 1)
        more = table.column("more").combine_chunks().flatten().to_numpy().view(np.uint64)
        child, parent = similar_sets(
            listed.flatten().to_numpy(),
            ends,
            np.concatenate([fp, more.reshape(n, -1)], axis=1),
            table.column("own").to_numpy(),
            similarity,
            total,
        )
        return pa.table({"a": pa.array(nodes[child]), "b": pa.array(nodes[parent])})

    # What is dealt by root alone would satisfy the grouping, and keep a component in one task.
    apart = dealt.repartition("root", "low", "high")
    return apart.groupBy("root", "low", "high").applyInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    radius: int = 4,
    seed: int = 42,
    wide: int = 0,
    total: int | None = None,
    similarity: float | None = None,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Rows whose fingerprints are equal, or linked by steps of ``radius`` or fewer bits,
    share a component; its id is the smallest doc_id in it (null if it has none). With
    ``wide`` further fingerprints, a step has ``total`` or fewer bits over all of them.
    Null and blank texts have fingerprint zero and are linked like any other.
    Repeated rows are kept. An empty table gives no rows.

    With ``similarity``, a step needs sets of distinct shingles whose Jaccard similarity
    is at least that, and ``total`` or fewer bits over all fingerprints, which are of
    distinct shingles then. Candidates are what the vantage-point trees find within the
    radius; they prune nothing at the one that 0.8 takes, so what shares a band of least
    hashes is a candidate too.
    Texts are one if their sets are equal; texts without words are one another's only.
    """
    extra = ["bands"] if similarity is not None else []
    if similarity is not None:
        rows = cut_lineage(fingerprints(docs, words, seed, wide, distinct=True))
    else:
        # One fingerprint names itself; several are named by a hash of all.
        node = F.xxhash64("fp", "more") if wide else F.col("fp")
        rows = cut_lineage(fingerprints(docs, words, seed, wide).withColumn("node", node))
    prints = cut_lineage(
        rows.groupBy("node", "fp", "more", *extra).agg(F.min("doc_id").alias("first"))
    )
    if similarity is not None:
        searched = fingerprint_links(prints, radius)
        loose = connected_components(searched.unionByName(candidate_links(prints)))
        most = 64 * (1 + wide) if total is None else total
        roots = connected_components(
            confirmed_links(docs, prints, loose, words, seed, similarity, most)
        )
    else:
        roots = connected_components(fingerprint_links(prints, radius, total))
    linked = prints.join(roots, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = linked.join(smallest, "root").select("node", "component_id")
    return rows.join(classes, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def keep_first(
    docs: DataFrame,
    words: int = 5,
    radius: int = 16,
    wide: int = 2,
    total: int = 38,
    similarity: float | None = None,
) -> DataFrame:
    """The rows of ``docs``, with their columns, less all but one of each component.

    By default 192 bits, linked where four fifths agree: texts whose shingles have a
    Jaccard similarity of 0.8 differ in 29 give or take 5, unrelated ones in 96 give or
    take 7. The first 64 differ in no more than 16 then, but for one pair in seventy.
    With ``similarity``, links are confirmed by the shingles themselves; ``total`` has to
    be wide enough then to pass every similar pair, and a small radius saves work.
    The smallest doc_id of a component stays, in one row. Rows without doc_id stay if
    no row of their component has one.
    """
    found = near_duplicates(
        docs, words, radius, wide=wide, total=total, similarity=similarity
    ).select("doc_id", "component_id")
    first = cut_lineage(
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").count()
    )
    mark = unused("kept", docs)
    kept = docs.join(
        first.select(F.col("doc_id").alias(mark)),
        F.col("doc_id").cast("long").eqNullSafe(F.col(mark)),
        "left_semi",
    )
    if first.filter("count > 1 and doc_id is not null").isEmpty():
        return kept
    named = kept.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return named.unionByName(kept.filter(F.col("doc_id").isNull()))
