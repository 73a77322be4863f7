"""Centroids of balanced posting lists, and the graph by which they are searched in memory."""

from __future__ import annotations

import numpy as np

#: Neighbours of a centroid in the graph: nearest ones that no nearer neighbour hides, and some anywhere.
NEAR, FAR, ENTRIES = 24, 4, 16


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of a from every row of b."""
    found = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.maximum(found, 0, out=found)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 4) -> np.ndarray:
    """About ``lists`` centroids with about as many vectors of the sample each.

    Halves are split at the median along the line between two means, largest
    first; then Lloyd rounds in which a full list seems farther than it is.
    """
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        at = max(range(len(parts)), key=lambda i: len(parts[i]))
        part = parts.pop(at)
        if len(part) < 2:
            parts.append(part)
            break
        points = sample[part]
        low, high = points[0], points[squares(points[:1], points)[0].argmax()]
        for _ in range(3):
            order = np.argsort(points @ (high - low), kind="stable")
            half = len(part) // 2
            low, high = points[order[:half]].mean(axis=0), points[order[half:]].mean(axis=0)
        parts += [part[order[:half]], part[order[half:]]]
    centroids = np.stack([sample[p].mean(axis=0) for p in parts])
    counts = np.array([len(p) for p in parts])
    for _ in range(rounds):
        full = counts / counts.mean() - 1
        near, scale = np.empty(len(sample), int), 0.0
        for i in range(0, len(sample), 4096):
            found = squares(sample[i : i + 4096], centroids)
            scale = scale or found.min(axis=1).mean()
            near[i : i + 4096] = (found + 0.1 * scale * full).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        used = counts > 0
        centroids[used] = sums[used] / counts[used, None]
    return np.unique(centroids, axis=0)


def graph(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each centroid's neighbours (a row each, filled up with itself) and the centroids where a search starts."""
    n = len(centroids)
    rows: list[set[int]] = [set() for _ in range(n)]
    for start in range(0, n, 1024):
        found = squares(centroids[start : start + 1024], centroids)
        nearest = np.argpartition(found, min(2 * NEAR, n - 1), axis=1)[:, : 2 * NEAR + 1]
        for i, (dist, among) in enumerate(zip(found, nearest, strict=True), start):
            among = among[np.argsort(dist[among], kind="stable")]
            among = among[among != i]
            apart, kept = squares(centroids[among], centroids[among]), []
            for j in range(len(among)):
                if len(kept) < NEAR // 2 and all(apart[j, k] >= dist[among[j]] for k in kept):
                    kept.append(j)
            rows[i].update(among[kept].tolist())
    for i, near in enumerate([list(r) for r in rows]):
        for j in near:  # a link leads both ways while there is room
            if len(rows[j]) < NEAR:
                rows[j].add(i)
    anywhere = np.random.default_rng(n).integers(0, n, (n, FAR))
    out = np.repeat(np.arange(n, dtype=np.int32)[:, None], NEAR + FAR, axis=1)
    for i, r in enumerate(rows):
        out[i, : len(r)] = sorted(r)
        out[i, NEAR:] = anywhere[i]
    return out, np.unique(np.linspace(0, n - 1, ENTRIES).astype(np.int32))


def walk(points: np.ndarray, centroids: np.ndarray, neighbours: np.ndarray, entries: np.ndarray, ratio: float, pool: int, steps: int = 8, least: float = 0.0, sure: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """For each point the ``pool`` nearest centroids that a search of the graph meets (-1: none), nearest first, and their distances.

    A step visits the neighbours of each point's nearest unvisited centroids; it
    ends when none within ``ratio`` times the least distance (or ``least``, if
    that is more) or among the ``sure`` nearest is left.
    """
    n, k = len(points), len(centroids)
    pool = min(pool, k)
    ids = np.full((n, pool), -1, np.int32)
    dist = np.full((n, pool), np.inf)
    done = np.zeros((n, pool), bool)
    seen = np.zeros((n, k), bool)

    def merge(row: np.ndarray, node: np.ndarray) -> None:
        """Put nodes (ordered by row) into the pools of their rows."""
        gap = points[row] - centroids[node]
        far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        touched, first, count = np.unique(row, return_index=True, return_counts=True)
        wide = int(count.max())
        at = np.arange(len(row)) - np.repeat(first, count)
        of = np.repeat(np.arange(len(touched)), count)
        new_ids, new_dist = np.full((len(touched), wide), -1, np.int32), np.full((len(touched), wide), np.inf)
        new_ids[of, at], new_dist[of, at] = node, far
        all_ids = np.concatenate([ids[touched], new_ids], axis=1)
        all_dist = np.concatenate([dist[touched], new_dist], axis=1)
        all_done = np.concatenate([done[touched], np.zeros(new_ids.shape, bool)], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :pool]
        ids[touched], dist[touched], done[touched] = (np.take_along_axis(x, order, axis=1) for x in (all_ids, all_dist, all_done))

    seen[:, entries] = True
    merge(np.repeat(np.arange(n), len(entries)), np.tile(entries, n))
    while True:
        live = ~done & (ids >= 0) & ((dist <= ratio * np.maximum(dist[:, :1], least)) | (np.arange(pool) < sure))
        live &= live.cumsum(axis=1) <= steps
        row, place = np.nonzero(live)
        if not len(row):
            return ids, dist
        done[row, place] = True
        found = np.repeat(row, neighbours.shape[1]) * k + neighbours[ids[row, place]].ravel()
        found = np.unique(found[~seen.ravel()[found]])
        if len(found):
            seen.ravel()[found] = True
            merge(found // k, found % k)


def homes(ids: np.ndarray, dist: np.ndarray, centroids: np.ndarray, ratio: float, copies: int, hidden: float = 0.25) -> np.ndarray:
    """Which of the nearest centroids (as from ``walk``) take a copy of each point.

    The nearest does; others within ``ratio`` of its distance do, unless a
    centroid that has the point already is much nearer to them (``hidden`` times
    the distance) than the point is.
    """
    taken = np.zeros(ids.shape, bool)
    taken[:, 0] = ids[:, 0] >= 0
    for j in range(1, ids.shape[1]):
        fits = (ids[:, j] >= 0) & (dist[:, j] <= ratio * dist[:, 0]) & (taken.sum(axis=1) < copies)
        for i in range(j):
            gap = np.linalg.norm(centroids[ids[:, i]] - centroids[ids[:, j]], axis=1)
            fits &= ~taken[:, i] | (gap >= hidden * dist[:, j])
        taken[:, j] = fits
    return taken
