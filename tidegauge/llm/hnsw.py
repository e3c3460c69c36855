"""A hierarchical navigable small-world graph over unit vectors, in numpy, for one shard."""

from __future__ import annotations

import heapq

import numpy as np

LINKS = 12
BUILD_BEAM = 40


class Graph:
    """Neighbour tables by level; level 0 holds every vector, each higher one a random part of it."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        n = len(vectors)
        self.vectors = vectors
        levels = np.random.default_rng(seed).exponential(1 / np.log(LINKS), n).astype(int)
        self.tables = [np.full((n, 2 * LINKS if level == 0 else LINKS), -1, np.int32) for level in range(levels.max(initial=0) + 1)]
        self.entry = 0
        self.top = int(levels[0]) if n else 0
        self._seen, self._stamp = np.zeros(n, np.int32), 0
        for i in range(1, n):
            self._insert(i, int(levels[i]))

    def _neighbours(self, level: int, nodes) -> np.ndarray:
        found = self.tables[level][nodes].ravel()
        return found[found >= 0]

    def _beam(self, query: np.ndarray, starts: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` most similar nodes that a beam of this width reaches, best first."""
        self._stamp += 1
        self._seen[starts] = self._stamp
        first = (self.vectors[starts] @ query).tolist()
        best = list(zip(first, starts))
        heapq.heapify(best)
        ahead = [(-s, x) for s, x in best]
        heapq.heapify(ahead)
        while ahead:
            similarity, node = heapq.heappop(ahead)
            if len(best) >= width and -similarity < best[0][0]:
                break
            new = self._neighbours(level, node)
            new = new[self._seen[new] != self._stamp]
            if not len(new):
                continue
            self._seen[new] = self._stamp
            for s, x in zip((self.vectors[new] @ query).tolist(), new.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, x))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, x))
                else:
                    continue
                heapq.heappush(ahead, (-s, x))
        return sorted(best, reverse=True)

    def _spread(self, near: np.ndarray, own: np.ndarray, count: int) -> np.ndarray:
        """Of nodes sorted by similarity, those nearer to the query than to one already taken; then the rest."""
        between = self.vectors[near] @ self.vectors[near].T
        taken, left = [], []
        for k in range(len(near)):
            if len(taken) < count and (not taken or between[k, taken].max() < own[k]):
                taken.append(k)
            else:
                left.append(k)
        return near[(taken + left)[:count]]

    def _connect(self, level: int, node: int, other: int) -> None:
        row = self.tables[level][node]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        near = np.append(row, other)
        own = self.vectors[near] @ self.vectors[node]
        order = np.argsort(-own, kind="stable")
        row[:] = -1
        kept = self._spread(near[order], own[order], len(row) * 3 // 4)
        row[: len(kept)] = kept

    def _insert(self, node: int, level: int) -> None:
        query = self.vectors[node]
        starts = [self.entry]
        for above in range(self.top, level, -1):
            starts = [self._beam(query, starts, 1, above)[0][1]]
        for at in range(min(level, self.top), -1, -1):
            found = self._beam(query, starts, BUILD_BEAM, at)
            starts = [x for _, x in found]
            near, own = np.array(starts, np.int32), np.array([s for s, _ in found])
            chosen = self._spread(near, own, LINKS)
            self.tables[at][node, : len(chosen)] = chosen
            for other in chosen.tolist():
                self._connect(at, other, node)
        if level > self.top:
            self.entry, self.top = node, level

    def similar(self, query: np.ndarray, least: float, beam: int, known: int | None = None) -> np.ndarray:
        """Nodes of at least this similarity that a beam finds, and all that hang together with them.

        ``known`` is the query's own node, if it is in the graph: the walk starts from it too.
        """
        starts = [self.entry]
        for level in range(self.top, 0, -1):
            starts = [self._beam(query, starts, 1, level)[0][1]]
        found = self._beam(query, starts, beam, 0)
        inside = np.array([x for s, x in found if s >= least], np.int32)
        if known is not None:
            inside = np.union1d(inside, [known]).astype(np.int32)
        if not len(inside):
            return inside
        self._stamp += 1
        self._seen[inside] = self._stamp
        parts, edge = [inside], inside
        while len(edge):
            new = np.unique(self._neighbours(0, edge))
            new = new[self._seen[new] != self._stamp]
            self._seen[new] = self._stamp
            edge = new[self.vectors[new] @ query >= least] if len(new) else new
            parts.append(edge)
        return np.concatenate(parts)


def restored(vectors: np.ndarray, tables: list[np.ndarray], entry: int, top: int) -> Graph:
    """A graph from its parts, without building it again."""
    graph = Graph.__new__(Graph)
    graph.vectors, graph.tables, graph.entry, graph.top = vectors, tables, entry, top
    graph._seen, graph._stamp = np.zeros(len(vectors), np.int32), 0
    return graph
