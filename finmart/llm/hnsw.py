"""Hierarchical navigable small-world graph over unit vectors, built and searched in batches with numpy.

Nodes are inserted in a given order in growing batches: every batch searches the graph so far
and itself. Neighbours are chosen by the usual diversity rule (a candidate is kept if it is
nearer to the node than to any neighbour kept before). Searches of many queries run in step.
"""

from __future__ import annotations

import numpy as np

NEIGHBOURS = 12
GROUND_NEIGHBOURS = 24
BUILD_BEAM = 48
BATCH = 512
SEED = 5


def _top(ids: np.ndarray, sims: np.ndarray, k: int, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    if sims.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        return tuple(np.take_along_axis(x, at, axis=1) for x in (ids, sims, *others))
    return (ids, sims, *others)


class Graph:
    """``links[level][node]`` holds neighbour rows, -1 for none; nodes are rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        levels = np.random.default_rng(SEED).exponential(1 / np.log(NEIGHBOURS), n).astype(np.int64)
        if n:
            levels[0] = max(1, int(levels.max()))  # the first node is the entry of every level
        self.levels = levels
        self.links = [np.full((n, GROUND_NEIGHBOURS if level == 0 else NEIGHBOURS), -1, dtype=np.int32)
                      for level in range(int(levels.max(initial=0)) + 1)]
        at, size = 1, 1
        while at < n:
            self._insert(np.arange(at, min(n, at + size)))
            at += size
            size = min(BATCH, at)

    def _search_level(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int, upto: int,
                      ) -> tuple[np.ndarray, np.ndarray]:
        """Beam search from ``entry`` (Q, e) among the first ``upto`` nodes: (ids, sims), -1 for none."""
        links, q = self.links[level], len(queries)
        rows = np.arange(q)[:, None]
        visited = np.zeros((q, upto + 1), dtype=bool)
        visited[:, upto] = True  # where -1 points
        visited[rows, entry] = True
        ids = np.full((q, beam), -1, dtype=np.int64)
        sims = np.full((q, beam), -np.inf, dtype=np.float32)
        width = min(beam, entry.shape[1])
        ids[:, :width] = entry[:, :width]
        sims[:, :width] = np.where(entry[:, :width] >= 0, np.einsum("qed,qd->qe", self.vectors[entry[:, :width]], queries), -np.inf)
        done = ids < 0
        reach = max(1, min(16, beam // 12))
        active = np.arange(q)
        while len(active):
            waiting = np.where(done[active], -np.inf, sims[active])
            pick = np.argpartition(-waiting, min(reach, beam) - 1, axis=1)[:, :reach]
            fresh = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            going = fresh.any(axis=1)
            active, pick, fresh = active[going], pick[going], fresh[going]
            if not len(active):
                break
            nodes = np.where(fresh, np.take_along_axis(ids[active], pick, axis=1), -1)
            flags = done[active]
            np.put_along_axis(flags, pick, True, axis=1)
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(active), -1).astype(np.int64)
            near = np.where((near < 0) | (near >= upto), upto, near)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = upto
            own = active[:, None]
            near[visited[own, near]] = upto
            visited[own, near] = True
            kept = near < upto
            count = int(kept.sum(axis=1).max())
            if count == 0:
                done[active] = flags
                continue
            order = np.argsort(~kept, axis=1, kind="stable")[:, :count]
            near, kept = np.take_along_axis(near, order, axis=1), np.take_along_axis(kept, order, axis=1)
            found = np.einsum("qed,qd->qe", self.vectors[np.where(kept, near, 0)], queries[active])
            found[~kept] = -np.inf
            new_ids, new_sims, new_done = _top(
                np.concatenate((ids[active], np.where(kept, near, -1)), axis=1),
                np.concatenate((sims[active], found), axis=1), beam,
                np.concatenate((flags, ~kept), axis=1))
            ids[active], sims[active], done[active] = new_ids, new_sims, new_done
        return ids, sims

    def _descend(self, queries: np.ndarray, lowest: int, upto: int) -> np.ndarray:
        """Entry points for level ``lowest``."""
        entry = np.zeros((len(queries), 1), dtype=np.int64)
        for level in range(len(self.links) - 1, lowest, -1):
            ids, sims = self._search_level(queries, entry, level, 2, upto)
            entry = np.take_along_axis(ids, sims.argmax(axis=1)[:, None], axis=1)
        return entry

    def _diverse(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of the candidates (N, C) of each node; nearest first, spread out, then filled up."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        real = (sims > -np.inf) & (ids >= 0) & (ids != nodes[:, None])
        if ids.shape[1] > 1:
            spots = np.where(real, ids, -1)
            at = np.argsort(spots, axis=1, kind="stable")
            sorted_ids = np.take_along_axis(spots, at, axis=1)
            twice = np.zeros_like(real)
            np.put_along_axis(twice, at[:, 1:], (sorted_ids[:, 1:] == sorted_ids[:, :-1]) & (sorted_ids[:, 1:] >= 0), axis=1)
            real &= ~twice
        points = self.vectors[np.where(real, ids, 0)]
        between = np.einsum("ncd,nkd->nck", points, points)
        kept = np.zeros_like(real)
        counts = np.zeros(len(nodes), dtype=np.int64)
        for c in range(ids.shape[1]):
            blocked = ((between[:, c, :] > sims[:, c:c + 1]) & kept).any(axis=1)
            take = real[:, c] & ~blocked & (counts < most)
            kept[:, c] = take
            counts += take
        rank = np.where(kept, 0, np.where(real, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        best = np.argsort(rank, axis=1, kind="stable")[:, :most]
        chosen = np.where(np.take_along_axis(real, best, axis=1), np.take_along_axis(ids, best, axis=1), -1)
        out = np.full((len(nodes), most), -1, dtype=np.int32)
        out[:, :chosen.shape[1]] = chosen
        return out

    def _insert(self, batch: np.ndarray) -> None:
        upto = int(batch[0])
        for level in range(len(self.links)):
            nodes = batch[self.levels[batch] >= level]
            if not len(nodes):
                continue
            queries = self.vectors[nodes]
            ids, sims = self._search_level(queries, self._descend(queries, level, upto), level, BUILD_BEAM, upto)
            inner = queries @ queries.T
            np.fill_diagonal(inner, -np.inf)
            own_ids, own_sims = _top(np.broadcast_to(nodes, inner.shape), inner, min(16, len(nodes)))
            links = self.links[level]
            most = links.shape[1]
            chosen = self._diverse(nodes, np.concatenate((ids, own_ids), axis=1), np.concatenate((sims, own_sims), axis=1), most // 2)
            links[nodes, :most // 2] = chosen
            self._link_back(level, nodes, chosen)

    def _link_back(self, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[level]
        source, target = np.repeat(nodes, chosen.shape[1]), chosen.reshape(-1)
        source, target = source[target >= 0], target[target >= 0].astype(np.int64)
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        touched, first, counts = np.unique(target, return_index=True, return_counts=True)
        for lo in range(0, len(touched), BATCH):
            part = slice(lo, lo + BATCH)
            most = int(counts[part].max())
            new = np.full((len(touched[part]), most), -1, dtype=np.int64)
            for j in range(most):
                has = counts[part] > j
                new[has, j] = source[first[part][has] + j]
            ids = np.concatenate((links[touched[part]].astype(np.int64), new), axis=1)
            sims = np.einsum("ncd,nd->nc", self.vectors[np.maximum(ids, 0)], self.vectors[touched[part]])
            sims[ids < 0] = -np.inf
            if most > 64:
                ids, sims = _top(ids, sims, 96)
            links[touched[part]] = self._diverse(touched[part], ids, sims, links.shape[1])

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sims) of up to ``beam`` neighbours per query, unordered, -1 for none."""
        n = len(self.vectors)
        return self._search_level(queries, self._descend(queries, 0, n), 0, min(beam, n), n)

    def within(self, queries: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
        """Nodes with a similarity of ``least`` or more per query.

        A query whose beam holds nothing below ``least`` may have missed some: its beam doubles
        until it does, or holds all nodes.
        """
        found: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(queries)
        left = np.arange(len(queries))
        while len(left):
            beam, again = min(beam, len(self.vectors)), []
            step = max(8, min(BATCH, (1 << 18) // beam))
            for at in range(0, len(left), step):
                some = left[at:at + step]
                ids, sims = self.search(queries[some], beam)
                near = (sims >= least) & (ids >= 0)
                full = near.all(axis=1) & (beam < len(self.vectors))
                again.append(some[full])
                for i in np.flatnonzero(~full):
                    found[some[i]] = ids[i][near[i]]
            left = np.concatenate(again) if again else left[:0]
            beam *= 2
        return found
