"""A robust-pruned directed graph over one shard of vectors, built and searched in batches.

Nearness is the inner product. For building, vectors get one more component that makes their
norms equal, so that a larger inner product is a smaller distance. Points are inserted in
batches: greedy beam searches on the graph so far propose neighbours, relaxed distance pruning
(factor `alpha`) keeps diverse edges, and reverse edges are pruned the same way.
"""

from __future__ import annotations

import numpy as np


def lift(x: np.ndarray) -> np.ndarray:
    """The vectors with a component that gives all of them the same norm (1 for the longest)."""
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    top = norm.max() if len(norm) else 1.0
    scaled = x / top
    rest = np.sqrt(np.maximum(0.0, 1.0 - (norm / top) ** 2))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


class Graph:
    """Neighbour lists (-1: none) of `x` with at most `degree` edges a point."""

    def __init__(self, x: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, batch: int = 256):
        self.x = lift(np.asarray(x, np.float64))
        self.n, self.degree, self.alpha = len(self.x), degree, np.float32(alpha * alpha)
        self.edges = np.full((self.n, degree), -1, np.int32)
        if not self.n:
            return
        self.entry = int(np.argmax(self.x @ self.x.mean(axis=0)))
        order = np.concatenate(([self.entry], np.delete(np.arange(self.n), self.entry)))
        at, size = 1, 1
        while at < self.n:
            new = order[at:at + size]
            found, _ = self.search(self.x[new], beam)
            # points of the same batch don't see each other in the graph, but may be neighbours
            mates = np.broadcast_to(new[:64], (len(new), min(64, len(new))))
            self.link(new, np.concatenate([found, mates], axis=1))
            at, size = at + len(new), min(batch, 2 * size)

    def prune(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Per point at most `degree` of its candidates (-1: none), diverse and nearest first."""
        b, c = cand.shape
        cand = np.sort(cand, axis=1)
        dup = np.zeros(cand.shape, bool)
        dup[:, 1:] = cand[:, 1:] == cand[:, :-1]
        bad = dup | (cand < 0) | (cand == points[:, None])
        vec = self.x[np.maximum(cand, 0)]
        dist = 1 - np.einsum("bd,bcd->bc", self.x[points], vec)
        dist[bad] = np.inf
        order = np.argsort(dist, axis=1)[:, :max(96, self.degree)]
        rows = np.arange(b)[:, None]
        cand, dist, vec = cand[rows, order], dist[rows, order], vec[rows, order]
        between = 1 - np.matmul(vec, vec.transpose(0, 2, 1))
        alive = np.isfinite(dist)
        out = np.full((b, self.degree), -1, np.int32)
        for k in range(self.degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            i = np.arange(b)
            out[some, k] = cand[i, pick][some]
            alive &= self.alpha * between[i, pick] > dist
            alive[i, pick] = False
        return out

    def link(self, new: np.ndarray, cand: np.ndarray) -> None:
        """Out-edges of the new points, then the reverse edges."""
        own = self.prune(new, cand)
        self.edges[new] = own
        src = np.repeat(new, self.degree)
        dst = own.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        targets, starts, counts = np.unique(dst, return_index=True, return_counts=True)
        width = 64                           # a target with more new edges is pruned in turns
        for turn in range(0, int(counts.max(initial=0)), width):
            some = counts > turn
            t, s, k = targets[some], starts[some] + turn, np.minimum(counts[some] - turn, width)
            inc = np.full((len(t), int(k.max())), -1, np.int64)
            col = np.arange(inc.shape[1])
            mask = col < k[:, None]
            inc[mask] = src[(s[:, None] + col)[mask]]
            for i in range(0, len(t), 512):
                part = slice(i, i + 512)
                self.edges[t[part]] = self.fit(t[part], np.concatenate([self.edges[t[part]], inc[part]], axis=1))

    def fit(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """The candidates as they are where they fit, else pruned."""
        small = (cand >= 0).sum(axis=1) <= self.degree
        out = np.full((len(points), self.degree), -1, np.int32)
        packed = -np.sort(-cand[small], axis=1)[:, :self.degree]
        packed[:, 1:][packed[:, 1:] == packed[:, :-1]] = -1
        out[small, :packed.shape[1]] = packed
        if not small.all():
            out[~small] = self.prune(points[~small], cand[~small])
        return out

    def search(self, q: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of lifted queries: (ids, inner products), best first, -1 where fewer are found."""
        b = len(q)
        ids = np.full((b, beam), -1, np.int64)
        val = np.full((b, beam), -np.inf, np.float32)
        done = np.ones((b, beam), bool)
        ids[:, 0], done[:, 0] = self.entry, False
        val[:, 0] = q @ self.x[self.entry]
        seen = np.zeros((b, self.n), bool)
        seen[:, self.entry] = True
        stamp = np.zeros((b, self.n), np.int32)
        rows = np.arange(b)
        while len(rows):
            open_ = np.where(done[rows], -np.inf, val[rows])
            w = min(width, beam)
            pick = np.argpartition(-open_, w - 1, axis=1)[:, :w]
            ok = np.isfinite(np.take_along_axis(open_, pick, 1))
            live = ok.any(axis=1)
            if not live.all():
                rows, pick, ok = rows[live], pick[live], ok[live]
                if not len(rows):
                    break
            at = np.where(ok, ids[rows[:, None], pick], self.entry)
            done[rows[:, None], pick] = True
            nb = np.where(ok[:, :, None], self.edges[at], -1).reshape(len(rows), -1)
            safe = np.maximum(nb, 0)
            fresh = (nb >= 0) & ~seen[rows[:, None], safe]
            col = np.broadcast_to(np.arange(nb.shape[1], dtype=np.int32), nb.shape)
            r = np.broadcast_to(rows[:, None], nb.shape)
            stamp[r[fresh], nb[fresh]] = col[fresh]
            fresh &= stamp[r, safe] == col   # a neighbour met twice in this step counts once
            seen[r[fresh], nb[fresh]] = True
            new = np.full(nb.shape, -np.inf, np.float32)
            i, j = np.nonzero(fresh)
            new[i, j] = np.einsum("id,id->i", q[rows[i]], self.x[nb[i, j]])
            all_val = np.concatenate([val[rows], new], axis=1)
            all_ids = np.concatenate([ids[rows], np.where(fresh, nb, -1)], axis=1)
            all_done = np.concatenate([done[rows], ~fresh], axis=1)
            best = np.argpartition(-all_val, beam - 1, axis=1)[:, :beam]
            val[rows], ids[rows], done[rows] = (np.take_along_axis(a, best, 1) for a in (all_val, all_ids, all_done))
        order = np.argsort(-val, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(val, order, 1)

    def nearest(self, q: np.ndarray, beam: int, block: int = 256) -> np.ndarray:
        """Ids of the `beam` points found for each raw query vector, -1 where fewer are found."""
        q = np.concatenate([np.asarray(q, np.float64), np.zeros((len(q), 1))], axis=1)
        q /= np.maximum(np.sqrt((q ** 2).sum(axis=1, keepdims=True)), 1e-300)
        q = q.astype(np.float32)
        parts = [self.search(q[i:i + block], beam)[0] for i in range(0, len(q), block)]
        return np.concatenate(parts) if parts else np.zeros((0, beam), np.int64)
