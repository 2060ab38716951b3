import hashlib
import math

import numpy as np
import pytest

from verbatide.llm.dual_tree import Codebooks, vector_codes
from verbatide.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def exhaustive(rows, parts, size, scale, rounds):
    """Plain Lloyd iterations over (vec_id, vector, label) in Python integers."""
    rows = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in rows]
    width = len(rows[0][1]) // parts
    cut = lambda v: [v[k * width : (k + 1) * width] for k in range(parts)]
    first = sorted(rows, key=lambda r: r[:2])[:size]
    books = [[cut(r[1])[k] for r in first] for k in range(parts)]

    def nearest(k, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(books[k]))

    for _ in range(rounds):
        taken = [[[] for _ in own] for own in books]
        for _, v, _ in rows:
            for k, x in enumerate(cut(v)):
                taken[k][nearest(k, x)[1]].append(x)
        books = [
            [[sum(c) // len(own) for c in zip(*own)] if own else c for own, c in zip(mine, held)]
            for mine, held in zip(taken, books)
        ]
    found = []
    for i, v, label in rows:
        hits = [nearest(k, x) for k, x in enumerate(cut(v))]
        found.append((i, label, "".join(f"{j:02x}" for _, j in hits), sum(d for d, _ in hits)))
    digest = hashlib.sha256(",".join(str(c) for own in books for e in own for c in e).encode()).hexdigest()
    totals = {}
    for _, label, _, error in found:
        totals[label] = totals.get(label, 0) + error
    return sorted((*r, totals[r[1]], digest) for r in found)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [1, 5, 64])
def test_against_exhaustive_search(spark, size):
    draw = np.random.default_rng(size)
    rows = [
        (int(i), [float(x) for x in np.float32(draw.choice([0.05, 0.5]) * draw.normal(size=8) + i % 3)], int(i % 4))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(vector_codes(df, parts=4, size=size)) == exhaustive(rows, 4, size, 256, 2)


def test_ties_and_copies(spark):
    rows = [(i, [float(x) for x in (i % 2, i % 3, 0, 1)], 0) for i in range(60)]
    rows += [(500 + i, [0.5, 0.5, 0.0, 1.0], 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(vector_codes(df, parts=2, size=8)) == exhaustive(rows, 2, 8, 256, 2)


def test_whole_nodes_are_assigned_by_sums():
    draw = np.random.default_rng(0)
    centres = np.array([[[-900, 0], [900, 0]]])
    points = np.concatenate([centres[0][i % 2] + draw.integers(-9, 9, (1, 2)) for i in range(4000)])
    books = Codebooks(centres)
    sums, counts = books.sums(points)
    assert counts.tolist() == [[2000, 2000]]
    assert (sums[0][0] == points[points[:, 0] < 0].sum(axis=0)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0], None), (2, [0.5, -1.0], 3), (2, [0.5, -1.0], 3), (None, [0.25, 0.5], None),
        (3, None, 1), (4, [nan, 0.0], 1), (5, [inf, 0.0], 1), (6, [None, 0.0], 1), (0, [], 9), (7, [1.0, 2.0, 3.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", code string, error string")
    found = vector_codes(df, parts=2, size=4).collect()
    assert sorted(-1 if r.vec_id is None else r.vec_id for r in found) == [-1, 0, 1, 2, 2, 7]
    by_id = {r.vec_id: r for r in found}
    assert by_id[0].code is None and by_id[7].error is None and by_id[7].label_error == by_id[2].label_error
    assert by_id[1].label_error == by_id[None].label_error
    assert vector_codes(df.limit(0), parts=2).collect() == []
    only = vector_codes(df.filter("vec_id is null"), parts=2).collect()
    assert [(r.vec_id, r.code) for r in only] == [(None, None)]


def test_refusals(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], SCHEMA)
    with pytest.raises(ValueError):
        vector_codes(df, parts=2)
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [1e9, 2.0], 1)], SCHEMA), parts=2)


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert result(QUERIES["op13_dual_tree_codes"](spark, small)) == exhaustive(rows, 16, 64, 256, 2)
