"""Near-duplicate embeddings by small-world graphs, one for each shard.

Two vectors are linked if their cosine, in double precision, is ``threshold`` or more;
components of links are the classes, named by their smallest id.

1. Equal vectors are one node with a number of ids, so exact copies are searched once.
2. Nodes are dealt by a hash to shards of at most about ``SHARD_BYTES`` of vectors
   (``MIN_SHARDS`` at least), and each shard builds its graph (:mod:`small_world`).
   Every node is in a graph.
3. Audits.  A shard turns ``AUDIT`` of its nodes to a cosine of just the threshold, the
   hardest case, and widens the beam until the share ``RECALL`` of them is found again.
   Each block of queries compares ``AUDIT_QUERIES`` of its own rows with the whole
   shard and widens the beam further until the same share of their links is found.
4. Every block of nodes queries every shard, a few blocks and one shard in a task.  A
   beam more than half full of links is widened again and again, and in the end all of
   the shard is compared, so groups of any size are counted and not capped.
5. Found pairs are verified: what single precision leaves open is computed in doubles.
   A task returns the number of links of each query, and of the links themselves only
   a spanning forest: enough for the components, and not the pairs of large groups.
6. Components are joined by Spark (:mod:`components`).

A link is missed only if a beam misses it, in the direction in which it is searched;
``tests`` measure recall against brute force.

Vectors that are null, zero or hold null or non-finite components, and rows without id,
link with nothing (the latter have no component_id and are kept).  Shorter vectors count
as followed by zeros.  Repeated rows are one vector and get equal results; vectors of one
id are one node of the components and no links of each other.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.components import components
from ledgerlark.llm.small_world import CAPACITY, Graph
from ledgerlark.llm.texts import mix
from ledgerlark.llm.vectors import matrix, met, numbered_blocks, packed, rows_a_block, unpacked, width_of
from ledgerlark.session import landed

THRESHOLD = 0.9
MIN_SHARDS = 4
SHARD_BYTES = 32 << 20
EF = 32
AUDIT = 256
AUDIT_QUERIES = 64
RECALL = 0.98
_FOREST = 1 << 20

_SHARD = "part int, ids binary, counts binary, vectors binary, component int, sizes binary, links binary, ef int"
_BLOCK = "block bigint, ids binary, digests binary, vectors binary, component int"
_FOUND = "a bigint, b bigint, digest binary, n bigint"
_DIGEST = 16  # bytes


_DIGESTED = "id bigint, digest binary, vector binary, component int"


def _prepare(width: int):
    """Each row's vector as bytes and its digest; null where it links with nothing."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, usable = matrix(batch.column(1), width)
            usable &= vectors.any(axis=1)
            rows = [packed(v + 0.0) if ok else (None, None) for v, ok in zip(vectors, usable, strict=True)]  # + 0.0: no -0.0
            digests = [None if v is None else xxhash.xxh3_128_digest(v) for v, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.int32()),
                ],
                names=["id", "digest", "vector", "component"],
            )

    return prepare


def _vectors(table: pa.Table, width: int) -> np.ndarray:
    kinds = np.asarray(table.column("component").to_pylist(), np.int64)
    data = table.column("vector").to_pylist()
    if len(kinds) and (kinds == kinds[0]).all():
        return unpacked(b"".join(data), int(kinds[0]), width)
    rows = [unpacked(d, k, width) for d, k in zip(data, kinds.tolist(), strict=True)]
    return np.concatenate(rows) if rows else np.zeros((0, width))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision; components of any size."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def slack(width: int) -> float:
    """More than a cosine in single precision can be off."""
    return (width + 8) * 2.0**-23


def turned(vectors: np.ndarray, threshold: float, seed: int) -> np.ndarray:
    """Each unit vector turned in some direction, to a cosine of ``threshold`` with itself."""
    away = np.random.default_rng(seed).normal(size=vectors.shape)
    away -= (away * vectors).sum(axis=1, keepdims=True) * vectors
    norms = np.linalg.norm(away, axis=1, keepdims=True)
    away = np.where(norms > 1e-9, away / np.maximum(norms, 1e-9), 0.0)
    return (threshold * vectors + np.sqrt(1 - threshold**2) * away).astype(np.float32)


def audited(graph: Graph, threshold: float, ef: int, seed: int) -> int:
    """The beam, doubled from ``ef``, with which turned nodes are found again."""
    n = len(graph.vectors)
    nodes = np.sort(np.argsort(mix(np.arange(n, dtype=np.uint64) + np.uint64(seed)))[:AUDIT])
    probes = turned(graph.vectors[nodes].astype(np.float64), threshold, seed)
    while 2 * ef <= n:
        _, found = graph.search(probes, ef)
        if (found == nodes[:, None]).any(axis=1).mean() >= RECALL:
            break
        ef *= 2
    return ef


def _build(width: int, threshold: float):
    def build(table: pa.Table) -> pa.Table:
        vectors, ids = _vectors(table, width), table.column("id").to_numpy()
        counts, part = table.column("n").to_numpy(), table.column("part")[0].as_py()
        by = np.lexsort((table.column("digest").to_pylist(), ids))  # the same graph if a task is run again
        vectors, ids, counts = vectors[by], ids[by], counts[by]
        graph, order = Graph.ordered(unit(vectors), mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        data, component = packed(vectors[order])
        row = {
            "part": part,
            "ids": ids[order].astype(np.int64).tobytes(),
            "counts": counts[order].astype(np.int64).tobytes(),
            "vectors": data,
            "component": component,
            "sizes": np.array(graph.sizes, np.int64).tobytes(),
            "links": b"".join(x.tobytes() for x in graph.layers),
            "ef": audited(graph, threshold, EF, part),
        }
        return pa.Table.from_pylist([row], pa.schema([(k, _ARROW[k]) for k in row]))

    return build


_ARROW = {
    "part": pa.int32(), "ids": pa.binary(), "counts": pa.binary(), "vectors": pa.binary(),
    "component": pa.int32(), "sizes": pa.binary(), "links": pa.binary(), "ef": pa.int32(),
}


class _Shard:
    def __init__(self, row: dict, width: int):
        self.ids, self.counts = (np.frombuffer(row[c], np.int64) for c in ("ids", "counts"))
        self.vectors, self.ef = unpacked(row["vectors"], row["component"], width), row["ef"]
        sizes, links = np.frombuffer(row["sizes"], np.int64).tolist(), np.frombuffer(row["links"], np.int32)
        layers, at = [], 0
        for i, size in enumerate(sizes):
            rows = size if i == 0 or i + 1 < len(sizes) else 0  # the topmost of several layers has no links
            layers.append(links[at : at + rows * CAPACITY].reshape(rows, CAPACITY))
            at += rows * CAPACITY
        self.graph = Graph(unit(self.vectors), sizes, layers)


def _blocks(width: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(table: pa.Table, k: int) -> pa.RecordBatch:
            data, component = packed(_vectors(table, width))
            ids, digests = table.column("id").to_numpy().astype(np.int64), table.column("digest").to_pylist()
            columns = [[k], [ids.tobytes()], [b"".join(digests)], [data], [component]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["block", "ids", "digests", "vectors", "component"],
            )

        yield from numbered_blocks(batches, make, rows_a_block(width))

    return blocks


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same ids as the given ones: each id to the smallest of its component."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(names))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        if np.array_equal(low, high):
            break
        np.minimum.at(label, high, low)
        while not np.array_equal(label, further := label[label]):
            label = further
    own = np.flatnonzero(label != np.arange(len(names)))
    return names[own], names[label[own]]


def _query(width: int, threshold: float):
    near = slack(width)

    def verified(shard: _Shard, vectors: np.ndarray, units: np.ndarray, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        keep = np.ones(len(q), bool)
        for k in range(0, len(q), 1 << 16):
            i, j = q[k : k + (1 << 16)], node[k : k + (1 << 16)]
            open_ = np.flatnonzero(np.einsum("ij,ij->i", units[i], shard.graph.vectors[j]) < threshold + near)
            keep[k + open_] = cosines(vectors[i[open_]], shard.vectors[j[open_]]) >= threshold
        return keep

    def beam(shard: _Shard, units: np.ndarray, ids: np.ndarray) -> int:
        some = units[np.argsort(mix(ids.astype(np.uint64)))[:AUDIT_QUERIES]]
        ef, true = shard.ef, int((some @ shard.graph.vectors.T >= threshold).sum())
        while 2 * ef <= len(shard.ids):
            found = sum(
                int((np.einsum("ij,ij->i", some[q], shard.graph.vectors[v]) >= threshold).sum())
                for q, v in shard.graph.within(some, threshold - near, ef)
            )
            if found >= RECALL * true:
                break
            ef *= 2
        return ef

    def work(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        digests: list[bytes] = []
        counts: list[int] = []
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for shard in (_Shard(s, width) for s in shards.to_pylist()) if blocks.num_rows else ():
            for row in blocks.select(["ids", "digests", "vectors", "component"]).to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = unpacked(row["vectors"], row["component"], width)
                units, n = unit(vectors), np.zeros(len(ids), np.int64)
                for q, node in shard.graph.within(units, threshold - near, beam(shard, units, ids)):
                    other = ids[q] != shard.ids[node]
                    q, node = q[other], node[other]
                    keep = verified(shard, vectors, units, q, node)
                    q, node = q[keep], node[keep]
                    np.add.at(n, q, shard.counts[node])
                    links.append(forest(ids[q], shard.ids[node]))
                    if sum(len(x) for x, _ in links) > _FOREST:
                        links = [forest(*map(np.concatenate, zip(*links, strict=True)))]
                at = np.flatnonzero(n)
                digests += [row["digests"][_DIGEST * k : _DIGEST * (k + 1)] for k in at]
                counts += n[at].tolist()
        x, y = forest(*map(np.concatenate, zip(*links, strict=True))) if links else (np.zeros(0, np.int64),) * 2
        both = lambda kind, of_links, of_nodes: pa.chunked_array(
            [
                pa.nulls(len(x), kind) if of_links is None else pa.array(of_links, kind),
                pa.nulls(len(counts), kind) if of_nodes is None else pa.array(of_nodes, kind),
            ]
        )
        return pa.table(
            {
                "a": both(pa.int64(), x, None),
                "b": both(pa.int64(), y, None),
                "digest": both(pa.binary(), None, digests),
                "n": both(pa.int64(), None, counts),
            }
        )

    return work


def near_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, row_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id): one row for each row of ``rows``."""
    rows = rows.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    width = width_of(rows, "vector")
    prepared = landed(rows.mapInArrow(_prepare(width), _DIGESTED), "vectors")
    known = prepared.filter("id IS NOT NULL AND digest IS NOT NULL")
    copies = known.select("digest", "id").distinct().groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("n"))
    copies = landed(copies, "copies")
    nodes = known.join(copies.select("digest", F.col("node").alias("id"), "n"), ["digest", "id"]).dropDuplicates(["digest"])
    nodes = landed(nodes.select("digest", "id", "n", "vector", "component"), "nodes")
    n_nodes = nodes.count()

    n_shards = max(MIN_SHARDS, -(-n_nodes * 4 * width // SHARD_BYTES))
    dealt = nodes.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(n_shards)).cast("int"))
    shards = landed(dealt.groupBy("part").applyInArrow(_build(width, threshold), _SHARD), "shards")
    blocks = landed(nodes.mapInArrow(_blocks(width), _BLOCK), "blocks")
    found = landed(met(blocks, shards, n_shards, _query(width, threshold), _FOUND), "found")

    linked = found.filter("digest IS NOT NULL").groupBy("digest").agg(F.sum("n").alias("more"))
    named = components(found.filter("a IS NOT NULL").select("a", "b")).select(F.col("id").alias("node"), "component")
    results = copies.join(linked, "digest", "left").join(named, "node", "left")
    results = results.select(
        "node",
        F.col("digest").alias("_digest"),
        (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    # Whoever has no links is a component alone and needs no partner to say so; vectors of one id share its component.
    results = results.filter("n_links > 0 OR component_id <> node")
    out = prepared.select("id", "digest").join(results, F.col("digest") == F.col("_digest"), "left")
    mine = F.col("id").isNotNull()
    return out.select(
        "id",
        F.when(mine, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        F.when(mine, F.coalesce("component_id", "id")).alias("component_id"),
    )
