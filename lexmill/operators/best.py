"""The k best rows of many queries, kept while scores pass by in tiles; memory is bounded by queries times k and a tile."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Scores of so many pairs (8 bytes each) are in memory at once.
TILE_CELLS = 1 << 20
#: Scores equal to nine places are equal.
PLACES, _SLACK = 9, 2e-9


def tile_rows(queries: int) -> int:
    return int(min(1024, max(1, TILE_CELLS // max(1, queries))))


def numbers(ids: pa.Array) -> np.ndarray:
    """Ids as an array that numpy can sort: integers, or objects."""
    return ids.to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else np.array(ids.to_pylist(), object)


class Best:
    """By falling score, then by id. With a cap, at most so many rows of a group count; lists of parts of the rows can then be merged by the same rule."""

    def __init__(self, queries: int, k: int, cap: int | None = None) -> None:
        self.n, self.k, self.cap = queries, k, cap
        self.least = np.full(queries, -np.inf)
        self.held: list[tuple] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None = None, groups: np.ndarray | None = None) -> None:
        """scores: a row of the tile by a query."""
        if allowed is not None:
            scores = np.where(allowed, scores, -np.inf)
        hit = (scores >= self.least - _SLACK) & np.isfinite(scores)
        if self.cap is None and len(ids) > self.k and hit.sum() > 2 * self.k * self.n:
            at = len(ids) - self.k
            hit &= scores >= np.partition(scores, at, axis=0)[at] - _SLACK
        d, q = np.nonzero(hit)
        if not len(d):
            return
        self.held.append((q, ids[d], scores[d, q], groups[d] if groups is not None else None))
        self.waiting += len(d)
        if self.waiting > 2 * self.n * self.k + 100_000:
            self._cut()

    def _cut(self) -> None:
        q, i, s = (np.concatenate([h[c] for h in self.held]) for c in range(3))
        g = np.concatenate([h[3] for h in self.held]) if self.cap is not None else None
        order = np.lexsort((i if i.dtype != object else np.unique(i, return_inverse=True)[1], -np.round(s, PLACES), q))
        if self.cap is not None:
            by_group = order[np.lexsort((g[order], q[order]))]  # stable
            same = (q[by_group][1:] == q[by_group][:-1]) & (g[by_group][1:] == g[by_group][:-1])
            over = np.zeros(len(q), bool)
            over[by_group] = _places(same) >= self.cap
            order = order[~over[order]]
        place = _places(q[order][1:] == q[order][:-1])
        last = order[place == self.k - 1]
        self.least[q[last]] = s[last]
        order = order[place < self.k]
        self.held = [(q[order], i[order], s[order], g[order] if g is not None else None)]
        self.waiting = 0

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score)."""
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self._cut()
        return self.held[0][:3]


def _places(same: np.ndarray) -> np.ndarray:
    """Each place within its run, from 0; same: whether the next one belongs to the run."""
    at = np.arange(len(same) + 1) if len(same) else np.zeros(1, np.int64)
    start = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), at, 0))
    return at - start
