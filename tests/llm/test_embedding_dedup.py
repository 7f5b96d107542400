"""Embedding near-dedup against brute force: links, components, groups of every size, odd vectors; the graphs by themselves."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerlark.llm import embedding_dedup as ed
from ledgerlark.llm.small_world import CAPACITY, Graph
from ledgerlark.llm.texts import mix
from ledgerlark.session import ship_package

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def brute(rows, threshold=0.9):
    """{row without label: (n_links, component)} over distinct (id, vector)."""
    width = max([len(v) for _, v, _ in rows if v is not None] or [1])
    nodes = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)})
    x = np.array([[*v, *[0.0] * (width - len(v))] for _, v in nodes], np.float32).astype(float).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    ids = np.array([i for i, _ in nodes])
    near &= ids[:, None] != ids
    label = {i: i for i in ids.tolist()}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(near), strict=True):
            low = min(label[ids[a]], label[ids[b]])
            for k in (ids[a], ids[b]):
                changed |= label[k] != low
                label[k] = low
    return {n: (int(near[k].sum()), label[n[0]]) for k, n in enumerate(nodes)}


def check(spark, rows, threshold=0.9, schema=SCHEMA):
    got = [tuple(r) for r in ed.near_vectors(spark.createDataFrame(rows, schema), threshold).collect()]
    want = brute([r[:3] for r in rows], threshold)
    expected = []
    for i, v, *_ in rows:
        usable = i is not None and v is not None and (i, tuple(v)) in want
        expected.append((i, *(want[(i, tuple(v))] if usable else (0, i))))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    return want


def floats(matrix):
    return [[float(np.float32(x)) for x in v] for v in matrix]


def test_clouds_chains_and_loners(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(700, 24))
    clouds = [rng.normal(size=24) + s * rng.normal(size=(k, 24)) for k, s in ((250, 0.15), (60, 0.3), (2, 0.1), (3, 0.25))]
    angles = np.arange(40) * 0.3  # neighbours linked, others not
    chain = np.zeros((40, 24))
    chain[:, 0], chain[:, 1] = np.cos(angles), np.sin(angles)
    vectors = floats(np.concatenate([base, *clouds, chain * 3]))
    order = rng.permutation(len(vectors)).tolist()
    want = check(spark, [(i, vectors[j], 0) for i, j in enumerate(order)])
    assert max(n for n, _ in want.values()) > 100 and len({c for _, c in want.values()}) < len(order) - 300


def test_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(2)
    vectors = floats(rng.normal(size=(200, 8)))
    rows = [(i, vectors[0] if i % 3 == 0 else vectors[i % 200], 0) for i in range(600)]
    check(spark, rows)


def test_ties_repeated_rows_and_odd_vectors(spark):
    rows = [(i, [1.0, float(i % 3)], 0) for i in range(30)] + [(1, [1.0, 1.0], 0)] * 3 + [(2, [-5.0, 1.0], 0)]
    rows += [(50, None, 0), (51, [0.0, 0.0], 0), (52, [1.0, None], 0), (53, [float("nan"), 1.0], 0), (54, [1.0], 0)]
    rows += [(55, [float("inf"), 1.0], 0), (56, [], 0), (None, [1.0, 0.0], 0), (57, [-0.0, 2.0], 0), (58, [0.0, 2.0], 0)]
    rows += [(59, [3e38, 3e38], 0), (60, [1e-30, 1e-30], 0)]
    check(spark, rows)


def test_extra_columns_and_empty_tables(spark):
    rows = [(i, [1.0, i / 10], 0, 1, 2, 3) for i in range(20)]
    check(spark, rows, schema=SCHEMA + ", id int, digest int, n_links int")
    check(spark, [])
    check(spark, [(1, None, 0), (2, [0.0], 1)])


def test_thresholds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v, 0) for i, v in enumerate(floats(rng.normal(size=(300, 4))))]
    for threshold in (0.5, 0.99):
        check(spark, rows, threshold)


def test_recall_of_graphs():
    rng = np.random.default_rng(5)
    vectors = ed.unit(np.concatenate([rng.normal(size=(3000, 32)), rng.normal(size=32) + 0.2 * rng.normal(size=(900, 32))]))
    graph, order = Graph.ordered(vectors, mix(np.arange(3900, dtype=np.uint64) + np.uint64(9)))
    assert len(graph.sizes) == 2 and graph.layers[0].shape == (3900, CAPACITY)
    assert sorted(order) == list(range(3900))
    probes = ed.turned(graph.vectors.astype(float), 0.9, 3)
    ef = ed.audited(graph, 0.9, 16, 1)
    found = (graph.search(probes, ef)[1] == np.arange(3900)[:, None]).any(axis=1).mean()
    assert found >= 0.95
    true = graph.vectors @ graph.vectors.T >= 0.9
    got = np.zeros_like(true)
    for q, node in graph.within(graph.vectors, 0.9, 16):
        got[q, node] = True
    assert (got & ~true).sum() <= 10 and (got & true).sum() >= 0.999 * true.sum()


def test_forest_keeps_components():
    rng = np.random.default_rng(6)
    for n in (1, 5, 200):
        a, b = rng.integers(0, 300, n), rng.integers(0, 300, n)
        x, y = ed.forest(a, b)
        assert len(x) < len(set(a) | set(b)) and (y < x).all()
        want, got = ({k: k for k in range(300)} for _ in range(2))
        for label, links in ((want, zip(a, b, strict=True)), (got, zip(x, y, strict=True))):
            for p, q in links:
                low, high = sorted((label[p], label[q]))
                for k, v in label.items():
                    if v == high:
                        label[k] = low
        assert want == got
