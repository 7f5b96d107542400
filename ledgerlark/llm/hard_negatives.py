"""Hard-negative mining with bounds along spanning trees of anchors.

Components are scaled and rounded down to whole numbers, so scores are exact integer
inner products.  An anchor's positives are the best rows of its own label.  Its hard
negatives, for each positive, are the best rows of other labels whose score lies in a
window: ``low`` to ``high`` per cent of the positive's score.

1. Anchors are dealt, by label, to tiles of ``TILE_ANCHORS``.  Each tile has a minimum
   spanning tree over the distances of its anchors (Prim), walked from the root.
2. Rows are packed into blocks.  Every tile meets every block, a few blocks at a time.
3. The root is scored with all rows of a block.  For any other anchor c with parent p,
   ``<c, x> = <p, x> + <c - p, x>``, so the score lies within edge length times norm of
   x around the parent's score, which itself is exact or an interval; and within
   |c| |x| around zero.
4. Only rows whose interval reaches what is asked for are rescored: for positives, the
   same label and the worst of the best so far; for negatives, another label and one of
   the anchor's windows above the worst of that window's best so far.  The others keep
   their interval, from which the next anchors' bounds are made.
5. The best of each group of blocks are merged by a window with a limit.

All bounds are exact, with slack for rounding, so results equal brute force.

Rows without id, label or vector, or with a null or non-finite component, take no
part.  Shorter vectors count as followed by zeros.  Rows of one id with equal scores
count once, so repeated rows change nothing, and no row of the anchor's own id is its
positive.  Anchors without positives, and windows without rows, give no result.
Scores beyond 64 bits are held at the largest or smallest long.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.vectors import matrix, met, numbered_blocks, packed, rows_a_block, unpacked, width_of
from ledgerlark.session import landed

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
TILE_ANCHORS = 1024

_BLOCK = "block bigint, ids binary, labels binary, vectors binary, component int"
_TILE = _BLOCK.replace("block", "tile") + ", parents binary, edges binary"
_FOUND = "part int, place int, anchor_id bigint, other_id bigint, score bigint"
_MINED = "part int, place int, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
_SLACK = 1 + 1e-9
_LONG = np.iinfo(np.int64)


def scores(vectors: np.ndarray, anchor: np.ndarray, norms: np.ndarray, norm: float) -> np.ndarray:
    """Whole-number inner products as longs; doubles hold every partial sum as long as the norms allow it."""
    if not len(vectors) or norms.max() * norm < 2.0**52:
        return (vectors @ anchor).astype(np.int64)
    whole = [int(a) for a in anchor]
    sums = (sum(int(x) * a for x, a in zip(v, whole, strict=True)) for v in vectors)
    return np.array([min(_LONG.max, max(_LONG.min, s)) for s in sums], np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by Prim's method: the anchors in walking order (depth first), and for each of
    these its parent's position in that order (-1: root) and its distance to it."""
    n = len(vectors)
    square = (vectors**2).sum(axis=1)
    best, near = np.full(n, np.inf), np.full(n, -1)
    left, now = np.ones(n, bool), int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    children: list[list[int]] = [[] for _ in range(n)]
    root = now
    for _ in range(n - 1):
        left[now] = False
        d = square + square[now] - 2 * (vectors @ vectors[now])
        closer = left & (d < best)
        best[closer], near[closer] = d[closer], now
        now = int(np.argmin(np.where(left, best, np.inf)))
        if not left[now]:  # distances beyond the range of doubles
            now = int(np.argmax(left))
            near[now] = root
        children[near[now]].append(now)
    order, stack, parent = [], [(root, -1)], []
    while stack:
        v, p = stack.pop()
        parent.append(p)
        stack += [(c, len(order)) for c in reversed(children[v])]
        order.append(v)
    order, parent = np.array(order, np.int64), np.array(parent, np.int64)
    edges = np.linalg.norm(vectors[order] - vectors[order[np.maximum(parent, 0)]], axis=1) * _SLACK
    return order, parent, edges


def walk(
    vectors: np.ndarray,
    norms: np.ndarray,
    anchors: np.ndarray,
    parents: np.ndarray,
    edges: np.ndarray,
    wanted: Callable,
    take: Callable,
) -> int:
    """Goes through the tree; ``wanted(i, low, high)`` names the rows to score with anchor i, ``take(i, rows, scores)``
    gets them.  Returns how many scores were computed."""
    children = np.bincount(parents[1:], minlength=len(anchors)) if len(parents) > 1 else np.zeros(len(anchors), int)
    open_: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    done = 0
    for i, parent in enumerate(parents):
        norm = float(np.linalg.norm(anchors[i]))
        if parent < 0:
            exact = scores(vectors, anchors[i], norms, norm)
            low = high = exact.astype(np.float64)
            chosen = np.flatnonzero(wanted(i, low, high))
            take(i, chosen, exact[chosen])
            done += len(exact)
        else:
            low, high = open_[parent]
            reach, most = edges[i] * norms * _SLACK + 0.5, norm * norms * _SLACK + 0.5
            low, high = np.maximum(low - reach, -most), np.minimum(high + reach, most)
            chosen = np.flatnonzero(wanted(i, low, high))
            exact = scores(vectors[chosen], anchors[i], norms[chosen], norm)
            low[chosen] = high[chosen] = exact
            take(i, chosen, exact)
            done += len(exact)
            children[parent] -= 1
            if not children[parent]:
                del open_[parent]
        if children[i]:
            open_[i] = (low, high)
    return done


class Best:
    """The first ``k`` distinct (score, id): higher scores first, ties by smaller id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, ids: np.ndarray, scored: np.ndarray) -> None:
        if not len(ids):
            return
        ids, scored = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scored])
        order = np.lexsort((ids, ~scored))  # ~ turns the order of longs round without overflow
        ids, scored = ids[order], scored[order]
        new = np.append(True, (ids[1:] != ids[:-1]) | (scored[1:] != scored[:-1]))
        self.ids, self.scores = ids[new][: self.k], scored[new][: self.k]


def _block(scale: int, width: int):
    def columns(table: pa.Table) -> tuple[list, np.ndarray]:
        found, usable = matrix(table.column("vector").combine_chunks(), width)
        whole = np.floor(scale * found[usable])
        data, component = packed(whole)
        ids = table.column("id").to_numpy()[usable].astype(np.int64)
        labels = table.column("label").to_numpy()[usable].astype(np.int64)
        return [ids.tobytes(), labels.tobytes(), data, component], whole

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(table: pa.Table, k: int) -> pa.RecordBatch:
            return _one_row([k, *columns(table)[0]], _BLOCK)

        yield from numbered_blocks(batches, make, rows_a_block(width))

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(table: pa.Table, k: int) -> pa.RecordBatch:
            (ids, labels, data, component), whole = columns(table)
            order, parents, edges = spanning_tree(whole) if len(whole) else (np.zeros(0, np.int64),) * 3
            ids, labels = (np.frombuffer(x, np.int64)[order].tobytes() for x in (ids, labels))
            data, component = packed(whole[order])
            return _one_row([k, ids, labels, data, component, parents.tobytes(), edges.astype(np.float64).tobytes()], _TILE)

        yield from numbered_blocks(batches, make, TILE_ANCHORS)

    return blocks, tiles


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _fields(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in schema.split(","))])


def _one_row(values: list, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(_fields(schema).names, values, strict=True)}, _fields(schema))


class _Tile:
    def __init__(self, row: dict, width: int):
        self.part = row["part"]
        self.ids, self.labels, self.parents = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "parents"))
        self.edges = np.frombuffer(row["edges"], np.float64)
        self.vectors = unpacked(row["vectors"], row["component"], width)


def _rows_of(blocks: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for row in blocks.select(["ids", "labels", "vectors", "component"]).to_pylist():
        ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        if len(ids):
            vectors = unpacked(row["vectors"], row["component"], width)
            yield ids, labels, vectors, np.linalg.norm(vectors, axis=1)


def _positives(width: int, k: int):
    def work(blocks: pa.Table, tiles: pa.Table) -> pa.Table:
        out = []
        for tile in (_Tile(t, width) for t in tiles.to_pylist()) if blocks.num_rows else ():
            best = [Best(k) for _ in tile.ids]
            for ids, labels, vectors, norms in _rows_of(blocks, width):

                def wanted(i, _low, high):
                    return (labels == tile.labels[i]) & (ids != tile.ids[i]) & (high >= best[i].floor)  # noqa: B023

                walk(vectors, norms, tile.vectors, tile.parents, tile.edges, wanted, lambda i, at, s: best[i].add(ids[at], s))  # noqa: B023
            out += [(tile.part, i, int(tile.ids[i]), int(o), int(s)) for i, b in enumerate(best) for o, s in zip(b.ids, b.scores, strict=True)]
        return _table(out, _FOUND)

    return work


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _negatives(width: int, k: int, low_share: int, high_share: int):
    def work(blocks: pa.Table, tiles: pa.Table) -> pa.Table:
        out = []
        for row in tiles.to_pylist() if blocks.num_rows else ():
            tile = _Tile(row, width)
            windows: list[list[tuple]] = [[] for _ in tile.ids]
            for w in row["windows"] or ():
                bounds = window(w["score"], low_share, high_share)
                if bounds[0] <= bounds[1]:
                    windows[w["place"]].append((w["other_id"], w["score"], *bounds, Best(k)))
            for ids, labels, vectors, norms in _rows_of(blocks, width):

                def wanted(i, low, high):
                    any_window = np.zeros(len(ids), bool)  # noqa: B023
                    for _, _, least, most, best in windows[i]:  # noqa: B023
                        any_window |= (high >= max(least, best.floor)) & (low <= most)
                    return any_window & (labels != tile.labels[i])  # noqa: B023

                def take(i, at, exact):
                    for _, _, least, most, best in windows[i]:  # noqa: B023
                        inside = (exact >= least) & (exact <= most)
                        best.add(ids[at[inside]], exact[inside])  # noqa: B023

                walk(vectors, norms, tile.vectors, tile.parents, tile.edges, wanted, take)
            for i, of in enumerate(windows):
                for other, score, _, _, best in of:
                    head = (tile.part, i, int(tile.ids[i]), other, score)
                    out += [(*head, int(o), int(s)) for o, s in zip(best.ids, best.scores, strict=True)]
        return _table(out, _MINED)

    return work


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = _fields(schema)
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=fields)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` says which rows are anchors."""
    rows = rows.select(
        F.col(row_id).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
        anchor.alias("_anchor"),
    )
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    width = width_of(rows, "vector")
    make_blocks, make_tiles = _block(scale, width)
    blocks = landed(rows.select("id", "label", "vector").mapInArrow(make_blocks, _BLOCK), "vector-blocks")

    anchors = rows.filter("_anchor").select("id", "label", "vector").distinct()
    dealt = anchors.repartitionByRange(max(1, -(-anchors.count() // TILE_ANCHORS)), "label", "id")
    tiles = landed(dealt.mapInArrow(make_tiles, _TILE), "anchor-tiles")
    # A number for each tile: one row for TILE_ANCHORS anchors.
    numbers = tiles.select("tile").withColumn("part", F.row_number().over(Window.orderBy("tile")) - 1)
    tiles = landed(tiles.join(numbers, "tile"), "numbered-tiles")
    n_tiles = max(1, tiles.count())

    found = met(blocks, tiles, n_tiles, _positives(width, positives), _FOUND)
    best = Window.partitionBy("part", "place").orderBy(F.desc("score"), "other_id")
    chosen = landed(
        found.withColumn("r", F.dense_rank().over(best)).filter(f"r <= {positives}").drop("r").distinct(), "positives"
    )
    windows = chosen.groupBy("part").agg(F.collect_list(F.struct("place", "other_id", "score")).alias("windows"))
    tiles = tiles.join(windows, "part", "left")
    mined = met(blocks, tiles, n_tiles, _negatives(width, negatives, low, high), _MINED)
    of = Window.partitionBy("part", "place", "positive_id", "positive_score")
    ranked = mined.withColumn("rank", F.dense_rank().over(of.orderBy(F.desc("negative_score"), "negative_id")))
    ranked = ranked.filter(f"rank <= {negatives}").distinct()
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
