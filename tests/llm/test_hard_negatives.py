"""Hard negatives against brute force: windows, ties, clusters, odd vectors, huge scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import hard_negatives as hn
from ledgerlark.session import ship_package

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def brute(rows, every, positives=5, negatives=10):
    taken = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken[(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label)] = None
    taken = list(taken)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, v, label in taken:
        if i % every:
            continue
        same = sorted({(-dot(v, w), j) for j, w, m in taken if m == label and j != i})[:positives]
        other = sorted({(-dot(v, w), j) for j, w, m in taken if m != label})
        for s, p in same:
            inside = [(t, j) for t, j in other if 30 * -s <= 100 * -t <= 90 * -s][:negatives]
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, every, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    return sorted(tuple(r[n] for n in names) for r in hn.mine(df, F.col("vec_id") % every == 0).collect())


def clustered(n, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    v = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))
    return [(i, [float(np.float32(x)) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("dims, spread", [(3, 0.3), (16, 0.05), (16, 2.0)])
def test_equals_brute_force(spark, dims, spread):
    rows = clustered(300, dims, dims, spread)
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_several_tiles_and_blocks(spark, monkeypatch):
    rows = clustered(400, 4, 3)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 7)
    monkeypatch.setattr(hn, "rows_a_block", lambda width: 16)
    assert mined(spark, rows, 5) == brute(rows, 5)


def test_ties_repeated_rows_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(60)] + [(i, [0.5, 0.25 + i / 512], 3) for i in range(60, 90)]
    rows += rows[:10] + [(0, [2.0, 1.0], 0), (100, None, 1), (101, [1.0, None], 1), (102, [float("nan"), 1.0], 0)]
    rows += [(103, [float("inf"), 1.0], 0), (104, [1.0], 0), (105, [], 1), (106, [0.4, 0.2], None), (None, [0.4, 0.2], 1)]
    random.Random(1).shuffle(rows)
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_negative_and_huge_scores(spark):
    rows = [(i, [float(2.0**26 + i), -(2.0**27), float(i)], i % 2) for i in range(20)]
    rows += [(20 + i, [-1.0, float(i)], i % 2) for i in range(20)]
    assert mined(spark, rows, 4) == brute(rows, 4)


def test_extra_columns_and_empty_table(spark):
    rows = [(*r, 1, 2, 3) for r in clustered(50, 3, 1)]
    assert mined(spark, rows, 10, SCHEMA + ", id int, vector int, rank int") == brute([r[:3] for r in rows], 10)
    assert mined(spark, [], 10) == []


def test_tree_is_spanning_and_least():
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(size=(40, 3)) * 256)
    order, parents, edges = hn.spanning_tree(v)
    assert sorted(order) == list(range(40)) and parents[0] == -1 and all(parents[i] < i for i in range(1, 40))
    pairs = sorted((np.linalg.norm(v[i] - v[j]), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0  # Kruskal
    find = lambda x: x if root[x] == x else find(root[x])
    for d, i, j in pairs:
        if find(i) != find(j):
            root[find(i)] = find(j)
            total += d
    assert math.isclose(edges[1:].sum(), total, rel_tol=1e-6)


def test_bounds_skip_rows_of_close_anchors():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(2000, 8)) * 256)
    anchors = np.floor(rng.normal(size=(1, 8)) * 256) + rng.integers(-3, 4, size=(50, 8))
    order, parents, edges = hn.spanning_tree(anchors)
    anchors = anchors[order]
    got = {}
    done = hn.walk(
        rows, np.linalg.norm(rows, axis=1), anchors, parents, edges,
        lambda i, low, high: high >= 200_000, lambda i, at, s: got.update({i: {(a, x) for a, x in zip(at.tolist(), s.tolist()) if x >= 200_000}}),
    )
    assert done < 2000 * 50 / 4
    exact = (rows @ anchors.T).astype(np.int64)
    assert got == {i: {(a, exact[a, i]) for a in np.flatnonzero(exact[:, i] >= 200_000).tolist()} for i in range(50)}
