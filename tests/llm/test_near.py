"""Near-duplicates of texts and vectors (op9, op7), and components."""

import random
import re

import numpy as np
import xxhash

from pyspark.sql import functions as F

from verbatide.llm import itq as Q
from verbatide.llm import simhash_vptree as V
from tests.conftest import plan
from verbatide.llm.components import connected_components
from verbatide.llm.sampling import share_by_hash


def classes(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def test_components(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(200, 300)] + [(7, i) for i in range(8, 60)]
    pairs += [(draw.randrange(100, 180), draw.randrange(100, 180)) for _ in range(50)] + [(5, 5)]
    df = spark.createDataFrame([*pairs, (None, 3), *pairs[:9]], "x long, y long")
    found = {r.node: r.root for r in connected_components(df, "x", "y").collect()}
    want = classes(400, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert found.keys() == linked
    assert len({(want[n], r) for n, r in found.items()}) == len({want[n] for n in linked})
    assert connected_components(df.limit(0), "x", "y").collect() == []


def test_simhash(documents):
    draw = random.Random(4)
    words = ["a", "Bb", "ccc", "é", "dd"]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "One two"), (4, "one TWO"), (5, "É x"), (6, "é x")]
    base = [draw.choice(words) + str(draw.randrange(50)) for _ in range(400)]
    for i in range(7, 60):
        text = list(base)
        for _ in range(draw.randrange(6)):
            text[draw.randrange(400)] = "new"
        rows.append((i, draw.choice([" ", "\t"]).join(text)))
    prints = [plain_print(t) for _, t in rows]
    n = len(rows)
    close = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = classes(n, close)
    df = documents([*rows, rows[9], (None, "one two")])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in V.near_duplicates(df).collect())
    assert got[0] == (-1, f"{prints[3]:016x}", 3)
    assert got[1:] == sorted((i, f"{prints[i]:016x}", want[i]) for i in [*range(n), 9])
    kept = V.keep_first(df, words=4, radius=4, wide=0, total=None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))
    assert kept.columns == df.columns
    assert V.near_duplicates(documents([])).collect() == []
    assert V.keep_first(documents([(None, "a b"), (None, "a b")])).count() == 2


def test_shards_find_all_pairs(spark, monkeypatch):
    """Several shards and tree levels give the components of all pairs."""
    draw = np.random.default_rng(0)
    points = draw.integers(0, 1 << 63, 600, dtype=np.uint64)
    near = points[:300].copy()
    for _ in range(3):
        near ^= np.uint64(1) << draw.integers(0, 64, 300, dtype=np.uint64)
    every = np.unique(np.concatenate([points, near]))
    rows = [(int(x), int(x), []) for x in every.view(np.int64)]
    df = spark.createDataFrame(rows, "node long, fp long, more array<long>")
    edges = [(r.a, r.b) for r in V.fingerprint_links(df, 4).collect()]
    at = {int(x): i for i, x in enumerate(every.view(np.int64))}
    i, j = np.nonzero(V.distance(every[:, None], every[None]) <= 4)
    assert classes(len(at), [(at[a], at[b]) for a, b in edges]) == classes(len(at), zip(i, j))


def test_blocks_find_all_pairs(spark, monkeypatch):
    """Shards dealt into blocks of members and of queries: no group beyond their sizes."""
    monkeypatch.setattr(V, "MEMBER_BLOCK", 40)
    monkeypatch.setattr(V, "QUERY_BLOCK", 60)
    monkeypatch.setattr(V, "LEAST_SHARDS", 4)
    monkeypatch.setattr(V, "CELLS", 50)
    draw = np.random.default_rng(3)
    points = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    near = points[:200].copy()
    for _ in range(4):
        near ^= np.uint64(1) << draw.integers(0, 64, 200, dtype=np.uint64)
    # A crowd within the radius of one point.
    crowd = points[0] ^ (np.uint64(1) << np.arange(63, dtype=np.uint64))
    every = np.unique(np.concatenate([points, near, crowd]))
    rows = [(int(x), int(x), []) for x in every.view(np.int64)]
    df = spark.createDataFrame(rows, "node long, fp long, more array<long>")
    edges = [(r.a, r.b) for r in V.fingerprint_links(df, 4).collect()]
    at = {int(x): i for i, x in enumerate(every.view(np.int64))}
    i, j = np.nonzero(V.distance(every[:, None], every[None]) <= 4)
    assert classes(len(at), [(at[a], at[b]) for a, b in edges]) == classes(len(at), zip(i, j))


def test_share_by_hash(spark):
    df = spark.range(40000)
    some = share_by_hash(df, "id", 4000, 40000)
    assert 3600 <= some.count() <= 4400
    assert share_by_hash(df, "id", 40000, 40000).count() == 40000
    assert share_by_hash(df.limit(0), "id", 5, 0).count() == 0
    text = plan(some)
    assert "Sort" not in text and "TakeOrdered" not in text and "Exchange" not in text


def test_near_copies_go_and_others_stay(documents):
    """Five-word shingles: a similarity of 0.8 or more is found, 0.5 is left alone."""
    draw = random.Random(8)
    rows, kin = [], []
    for k in range(60):
        words = [f"w{draw.randrange(3000)}" for _ in range(400)]
        rows.append((2 * k, " ".join(words)))
        for at in draw.sample(range(400), 5 if k % 2 else 40):
            words[at] = "changed" + str(draw.randrange(9000))
        rows.append((2 * k + 1, " ".join(words)))
        if k % 2:
            kin.append(2 * k + 1)
    gone = {i for i, _ in rows} - {r.doc_id for r in V.keep_first(documents(rows)).collect()}
    assert gone <= set(kin) and len(gone) >= 0.9 * len(kin)


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 16)
    draw = np.random.default_rng(1)
    base = draw.normal(size=(40, 24))
    rows = []
    for k in range(40):
        for _ in range(60 if k == 0 else 3):
            v = base[k] + draw.normal(size=24) * draw.choice([0.02, 0.09])
            rows.append((len(rows), v.tolist(), k % 3))
    n = len(rows)
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 6, rows[0][1], None)]
    rows += [(n + 7, rows[0][1][:20], 0), (n + 8, [x * 1e200 for x in rows[0][1]], 0)]
    df = spark.createDataFrame([*rows, rows[3], (None, rows[0][1], 0)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in Q.embedding_duplicates(df).collect()}
    assert len(got) == len(rows) + 1 and got.pop(None) == (0, None, True)
    usable = [(i, v, l) for i, v, l in rows if i < n or i >= n + 7]
    vectors = np.array([(v + [0.0] * 24)[:24] for _, v, _ in usable])
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([l for _, _, l in usable])
    ids = [i for i, _, _ in usable]
    near = (vectors @ vectors.T >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    roots = classes(len(rows), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    want = {i: (0, i, True) for i, _, _ in rows}
    want |= {i: (int(near[k].sum()), roots[i], roots[i] == i) for k, i in enumerate(ids)}
    true, found = near.sum(), sum(v[0] for v in got.values())
    assert 0.9 * true <= found <= true and true > 1000
    assert found < true or got == want
    assert Q.embedding_duplicates(df.limit(0)).collect() == []
    assert Q.embedding_duplicates(df.filter("vec_id >= %d and vec_id < %d" % (n, n + 6))).count() == 6


def test_float_vectors(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = df.collect()
    vectors = np.array([r.embedding for r in rows], float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([r.label for r in rows])
    near = (vectors @ vectors.T >= 0.7) & (labels[:, None] == labels)
    found = sum(r.n_links for r in Q.embedding_duplicates(df, 0.7).collect())
    true = near.sum() - len(rows)
    assert 0.9 * true <= found <= true


def _shared(k, prefix, n=600, words=5):
    """Two texts of n shingles each, of which the first k are the same."""
    one = [f"{prefix}{i}" for i in range(n + words - 1)]
    two = one[: k + words - 1] + [f"{prefix}x{i}" for i in range(n - k)]
    return " ".join(one), " ".join(two)


def test_links_are_confirmed_by_shingles(spark, documents, monkeypatch):
    """Jaccard 0.8 or more goes, less stays, also beside a repeated line."""
    import corpus_pipeline

    monkeypatch.setattr(V, "SET_BLOCK", 2000)
    rows, kin = [], []
    # Of n shingles each, k shared: similarity k / (2n - k).
    for k in (494, 514, 533, 534, 540, 570):
        for copy in range(6):
            one, two = _shared(k, f"p{k}c{copy}w")
            rows += [(len(rows), one), (len(rows) + 1, two)]
            if k / (1200 - k) >= 0.8:
                kin.append(len(rows) - 1)
    # Two different texts, most of whose shingles are one line's repeats.
    line = " ".join(["all", "rights", "are", "reserved", "here"] * 400)
    for t in "ab":
        rows.append((len(rows), f"{line} " + " ".join(f"l{t}{i}" for i in range(60))))
    # Different lengths of the repeated line, and otherwise the same.
    body = " ".join(f"m{i}" for i in range(200))
    rows += [(len(rows), f"{body} {line}"), (len(rows) + 1, f"{body} " + " ".join(["all rights are reserved here"] * 5))]
    kin.append(rows[-1][0])
    kept = corpus_pipeline.first_of_near_copies(spark, documents(rows), None)
    assert {i for i, _ in rows} - {r.doc_id for r in kept.collect()} == set(kin)


def test_trees_find_near_copies_of_the_pipeline(spark, documents, monkeypatch):
    """Without any band in common, the fingerprints' trees find what lies within 4 bits."""
    import corpus_pipeline

    monkeypatch.setattr(V, "candidate_links", lambda prints: prints.selectExpr("node a", "node b").limit(0))
    rows, near = [], set()
    for copy in range(20):
        one, two = _shared(590, f"t{copy}w")
        rows += [(2 * copy, one), (2 * copy + 1, two)]
        prints = [V.simhash(np.unique(V.shingle_hashes(t, 5, 42))) for t in (one, two)]
        if (prints[0] ^ prints[1]).bit_count() <= 4:
            near.add(2 * copy + 1)
    kept = {r.doc_id for r in corpus_pipeline.first_of_near_copies(spark, documents(rows), None).collect()}
    assert len(near) > 5 and {i for i, _ in rows} - kept == near


def test_crowded_label_is_searched_whole(spark):
    """Short residuals: a label of which most is one tight group, against brute force."""
    draw = np.random.default_rng(5)
    centre = draw.normal(size=32)
    centre /= np.linalg.norm(centre)
    off = draw.normal(size=(1200, 32))
    off *= draw.choice([0.1, 0.14, 0.18], (1200, 1)) / np.linalg.norm(off, axis=1, keepdims=True)
    vectors = np.concatenate([centre + off, draw.normal(size=(100, 32))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.98).sum() - len(rows)
    got = Q.embedding_duplicates(df).collect()
    assert 0.995 * true <= sum(r.n_links for r in got) <= true


def test_shards_follow_all_dealt_rows(spark, monkeypatch):
    """Many labels, or a bucket dealt into blocks, make more shards, not larger ones."""
    monkeypatch.setattr(Q, "BLOCK", 16)
    monkeypatch.setattr(Q, "TASK_ROWS", 64)
    seen, links = [], Q.shard_number
    monkeypatch.setattr(Q, "shard_number", lambda rows, least: seen.append(rows) or links(rows, 1))
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=8).tolist(), i % 50) for i in range(1000)]
    rows += [(1000 + i, [1.0] * 8, 50) for i in range(160)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Q.embedding_duplicates(df).collect()
    # Every table deals each of 160 equal vectors to 10 blocks, and all others once.
    assert seen and seen[0] >= 160 * 10 + 1000 and links(seen[0], 1) >= seen[0] / 64
    assert sum(r.n_links for r in got if r.vec_id >= 1000) == 160 * 159


def test_recall_at_the_threshold(documents):
    """Pairs of similarity 89 / 111, a little above 0.8, among texts without a twin."""
    rows = []
    for i in range(300):
        words = [f"w{i}x{j}" for j in range(104)]
        rows.append((2 * i, " ".join(words)))
        words[40:47] = [f"v{i}x{j}" for j in range(7)]
        rows.append((2 * i + 1, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{i}x{j}" for j in range(60))) for i in range(100)]
    kept = {r.doc_id for r in V.keep_first(documents(rows), words=5, wide=2, total=54, similarity=0.8).collect()}
    assert {2 * i for i in range(300)} <= kept and set(range(1000, 1100)) <= kept
    found = sum(2 * i + 1 not in kept for i in range(300)) / 300
    assert found >= 0.97
    print("recall", found)


def test_columns_named_like_marks(documents):
    docs = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")])
    for name in ("_kept", "kept", "Kept_", "_wanted", "bands", "node"):
        docs = docs.withColumn(name, F.lit("clash"))
    kept = V.keep_first(docs, words=5, wide=2, total=54, similarity=0.8)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
