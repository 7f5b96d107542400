"""Hierarchical navigable small-world graphs in numpy, built and searched for many vectors at a time.

Nodes are ordered by level, so layer l holds the first ``sizes[l]`` of them.  A layer is
filled in batches: each batch looks for its nearest nodes in what the layer already
holds, entering from the layer above, and among itself; a node links to those that are
nearer to it than to any node it has linked already, then to the nearest of the rest (in
a cloud of near copies the first rule alone leaves a star), and is linked back.  A node
with too many links keeps a selection by the same rules.  The topmost layer, of at most
``SCANNED`` nodes, has no links: a query compares all of them.

A beam holds the ``ef`` best nodes seen by a query.  All beams of a block advance
together, a few nodes at a time, until no beam holds a node whose links are unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LINKS = 16  # chosen by a new node
CAPACITY = 48  # of a node, links back included
KEPT = 32  # of a node whose capacity is exceeded
BUILD_BEAM = 64
ENTRIES = 8
FIRST = 256
SCANNED = 1024
BATCH = 1024
STEP = 4
_CELLS = 1 << 25  # of the tables that a block of beams uses


def levels(hashes: np.ndarray) -> np.ndarray:
    """Levels of nodes from 64-bit hashes: each one has a ``LINKS``-th of the nodes of the level below."""
    share = (hashes.astype(np.float64) + 0.5) / 2.0**64
    return np.floor(-np.log(share) / np.log(LINKS)).astype(np.int64)


class Graph:
    """Unit vectors (n, d) in float32, ordered by level, and the links of each layer."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], layers: list[np.ndarray] | None = None):
        self.vectors, self.sizes = vectors, sizes
        self.layers = layers if layers is not None else [np.zeros((0, CAPACITY), np.int32) for _ in sizes]
        if layers is None:
            for layer in reversed(range(max(1, len(sizes) - 1))):
                self._fill(layer)

    @classmethod
    def ordered(cls, vectors: np.ndarray, hashes: np.ndarray) -> tuple[Graph, np.ndarray]:
        """The graph, and where each of its nodes was in ``vectors``."""
        level = levels(hashes)
        order = np.argsort(-level, kind="stable")
        sizes = [len(order)]
        while sizes[-1] > SCANNED and (more := int((level >= len(sizes)).sum())):
            sizes.append(more)
        return cls(np.ascontiguousarray(vectors[order]), sizes), order

    # -- building

    def _fill(self, layer: int) -> None:
        n = self.sizes[layer]
        above = self.sizes[layer + 1] if layer + 1 < len(self.sizes) else 0
        links = self.layers[layer] = np.full((n, CAPACITY), -1, np.int32)
        at = min(n, max(above, FIRST))
        for a in range(0, at, BATCH):
            own = np.arange(a, min(at, a + BATCH))
            sims = self.vectors[own] @ self.vectors[:at].T
            sims[np.arange(len(own)), own] = -np.inf
            self._link(links, own, *_best(sims, min(at, BUILD_BEAM)))
        while at < n:
            own = np.arange(at, min(n, at + min(at, BATCH)))
            sims, nodes = self.search(self.vectors[own], BUILD_BEAM, layer, at)
            among = self.vectors[own] @ self.vectors[own].T
            np.fill_diagonal(among, -np.inf)
            near, place = _best(among, min(len(own), LINKS))
            self._link(links, own, np.hstack([sims, near]), np.hstack([nodes, own[place]]))
            at += len(own)

    def _link(self, links: np.ndarray, own: np.ndarray, sims: np.ndarray, nodes: np.ndarray) -> None:
        sims, nodes = _sorted(sims, nodes)
        chosen = self._select(sims, nodes, LINKS)
        links[own, :LINKS] = chosen
        a, b = np.repeat(own, LINKS), chosen.ravel()
        a, b = a[b >= 0], b[b >= 0]
        # A pair of one batch that chose each other is linked back already.
        back = ~(links[b, :LINKS] == a[:, None]).any(axis=1)
        a, b = a[back], b[back]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        targets, first, n_new = np.unique(b, return_index=True, return_counts=True)
        have = (links[targets] >= 0).sum(axis=1)
        fits = have + n_new <= CAPACITY
        rank = np.arange(len(b)) - np.repeat(first, n_new)
        of = np.repeat(np.arange(len(targets)), n_new)
        easy = fits[of]
        links[b[easy], have[of[easy]] + rank[easy]] = a[easy]
        full = np.flatnonzero(~fits)
        full = full[np.argsort(n_new[full], kind="stable")]
        for k in range(0, len(full), 256):
            some = full[k : k + 256]
            wide = CAPACITY + int(n_new[some].max())
            nodes = np.full((len(some), wide), -1, np.int64)
            nodes[:, :CAPACITY] = links[targets[some]]
            for i, j in enumerate(some):
                nodes[i, CAPACITY : CAPACITY + n_new[j]] = a[first[j] : first[j] + n_new[j]]
            sims = np.einsum("ijk,ik->ij", self.vectors[np.maximum(nodes, 0)], self.vectors[targets[some]])
            sims[nodes < 0] = -np.inf
            sims, nodes = _sorted(sims, nodes)
            wide = min(wide, 2 * CAPACITY)  # of more candidates the nearest
            links[targets[some]] = -1
            links[targets[some], :KEPT] = self._select(sims[:, :wide], nodes[:, :wide], KEPT)

    def _select(self, sims: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Of candidates sorted by similarity those nearer to the node than to any candidate taken before, then the
        nearest of the rest; -1 where there are fewer."""
        near = self.vectors[np.maximum(nodes, 0)]
        between = near @ near.transpose(0, 2, 1)
        taken = np.zeros(nodes.shape, bool)
        valid = np.isfinite(sims) & (nodes >= 0)
        valid[:, 1:] &= nodes[:, 1:] != nodes[:, :-1]
        count = np.zeros(len(nodes), np.int64)
        out = np.full((len(nodes), most), -1, np.int32)
        for c in range(nodes.shape[1]):
            closer = (taken[:, :c] & (between[:, c, :c] > sims[:, c : c + 1])).any(axis=1)
            ok = valid[:, c] & ~closer & (count < most)
            taken[ok, c] = True
            out[ok, count[ok]] = nodes[ok, c]
            count[ok] += 1
        rest = valid & ~taken
        rank = np.cumsum(rest, axis=1) - 1 + count[:, None]
        i, c = np.nonzero(rest & (rank < most))
        out[i, rank[i, c]] = nodes[i, c]
        return out

    # -- searching

    def search(self, queries: np.ndarray, ef: int, layer: int = 0, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and nodes (-inf, -1 where there are fewer) of the ``ef`` best nodes found in a layer, unsorted."""
        size = self.sizes[layer] if size is None else size
        sims, nodes = np.empty((len(queries), ef), np.float32), np.empty((len(queries), ef), np.int64)
        few = max(1, _CELLS // max(size, (ef + STEP * CAPACITY) * 8))
        for a in range(0, len(queries), few):
            some = queries[a : a + few]
            top = layer + 2 >= len(self.sizes)
            if not top:
                entries = _sorted(*self.search(some, ENTRIES, layer + 1))[1]
            else:
                scanned = self.sizes[layer + 1] if layer + 1 < len(self.sizes) else min(size, FIRST)
                entries = _best(some @ self.vectors[: min(size, scanned)].T, min(size, scanned, ENTRIES))[1]
            sims[a : a + few], nodes[a : a + few] = self._beam(some, entries, ef, layer, size)
        return sims, nodes

    def within(self, queries: np.ndarray, least: float, ef: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) with a similarity of ``least`` or more, in portions of whole queries.

        A beam that is more than half full of such nodes may have left some out: its query is asked again with a beam
        four times as wide, and where that would be wider than half the graph, all nodes are compared.
        """
        left = np.arange(len(queries))
        while len(left) and 2 * ef <= len(self.vectors):
            again, few = [], max(1, _CELLS // max(len(self.vectors), 8 * ef))
            for a in range(0, len(left), few):
                some = left[a : a + few]
                sims, nodes = self.search(queries[some], ef)
                hits = sims >= least
                settled = 2 * hits.sum(axis=1) <= ef
                again.append(some[~settled])
                i, j = np.nonzero(hits & settled[:, None])
                yield some[i], nodes[i, j]
            left, ef = np.concatenate(again), 4 * ef
        few = max(1, (_CELLS >> 3) // max(1, len(self.vectors)))
        for a in range(0, len(left), few):
            some = left[a : a + few]
            i, j = np.nonzero(queries[some] @ self.vectors.T >= least)
            yield some[i], j

    def _beam(self, queries: np.ndarray, entries: np.ndarray, ef: int, layer: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        links, n = self.layers[layer], len(queries)
        width = max(ef, entries.shape[1])
        nodes, sims = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf, np.float32)
        nodes[:, : entries.shape[1]] = entries
        at = np.maximum(entries, 0)
        near = np.einsum("ijk,ik->ij", self.vectors[at], queries)
        sims[:, : entries.shape[1]] = np.where(entries >= 0, near, -np.inf)
        read = nodes < 0
        seen = np.zeros((n, size + 1), bool)  # the last column is for -1
        np.put_along_axis(seen, nodes, True, axis=1)
        active = np.arange(n)
        step = min(STEP, width)
        while True:
            open_ = np.where(read[active], -np.inf, sims[active])
            pick = np.argpartition(-open_, step - 1, axis=1)[:, :step]
            some = np.isfinite(np.take_along_axis(open_, pick, axis=1))
            going = some.any(axis=1)
            active, pick, some = active[going], pick[going], some[going]
            if not len(active):
                break
            rows = active[:, None]
            read[rows, pick] = True
            found = links[np.where(some, nodes[rows, pick], -1)].reshape(len(active), -1).astype(np.int64)
            found[np.repeat(~some, links.shape[1], axis=1)] = -1
            found[seen[rows, found]] = -1
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            seen[rows, found] = True
            i, j = np.nonzero(found >= 0)
            more = np.full(found.shape, -np.inf, np.float32)
            more[i, j] = np.einsum("ij,ij->i", self.vectors[found[i, j]], queries[active[i]])
            all_sims = np.hstack([sims[active], more])
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            sims[active] = np.take_along_axis(all_sims, best, axis=1)
            nodes[active] = np.take_along_axis(np.hstack([nodes[active], found]), best, axis=1)
            read[active] = np.take_along_axis(np.hstack([read[active], found < 0]), best, axis=1)
        if width > ef:
            return tuple(x[:, :ef] for x in _sorted(sims, nodes))
        return sims, nodes


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    place = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.take_along_axis(sims, place, axis=1), place


def _sorted(sims: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((nodes, -sims), axis=1) if sims.size else np.zeros(sims.shape, np.int64)
    return np.take_along_axis(sims, order, axis=1), np.take_along_axis(nodes, order, axis=1)
