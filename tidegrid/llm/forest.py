"""A forest of random-projection trees, and its search through one priority queue shared by all trees, for many queries at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """``directions`` (trees, nodes, dims) and ``cuts`` (trees, nodes) of complete trees in heap order; node 0 is not used."""

    directions: np.ndarray
    cuts: np.ndarray

    @property
    def depth(self) -> int:
        return int(np.log2(self.cuts.shape[1]))

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def visits(self, x: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
        """(n, visits) numbers of the leaves each query visits, tree * leaves + leaf, and which of them are its own (the first ``trees``).

        Every query descends all trees; each time it leaves a branch aside, that branch enters its queue with the largest margin on the way to it. Then the branch
        with the smallest margin, of whichever tree, is taken from the queue and descended in turn."""
        n, (trees, nodes, dims), depth = len(x), self.directions.shape, self.depth
        project = x @ self.directions.reshape(-1, dims).T if trees * nodes <= 4096 else None
        row = np.arange(n)
        slots = visits * depth
        cost = np.full((n, slots), np.inf, np.float32)
        where = np.zeros((n, slots), np.int32)
        out = np.empty((n, visits), np.int64)
        at = 0
        for v in range(visits):
            if v < trees:
                tree, local, base = np.full(n, v), np.ones(n, np.int64), np.zeros(n, np.float32)
            else:
                j = cost[:, :at].argmin(axis=1)
                base, code = cost[row, j], where[row, j].astype(np.int64)
                cost[row, j] = np.inf
                tree, local = code // (2 * nodes), code % (2 * nodes)
            spent = ~np.isfinite(base)  # nothing is left to visit: the own leaf again
            for _ in range(depth):
                inner = local < nodes
                f = tree * nodes + np.minimum(local, nodes - 1)
                dot = project[row, f] if project is not None else np.einsum("ij,ij->i", x, self.directions.reshape(-1, dims)[f])
                m = dot - self.cuts.reshape(-1)[f]
                right = m > 0
                cost[:, at] = np.where(inner & ~spent, np.maximum(base, np.abs(m)), np.inf)
                where[:, at] = tree * 2 * nodes + 2 * np.minimum(local, nodes - 1) + ~right
                local = np.where(inner, 2 * local + right, local)
                at += 1
            leaf = tree * self.leaves + local - self.leaves
            out[:, v] = np.where(spent, out[:, 0], leaf) if v else leaf
        return out, np.arange(visits) < trees


def fit(sample: np.ndarray, trees: int, depth: int, seed: int = 5) -> Forest:
    """Trees that halve the sample at each node: along the line between two of its points, at the median."""
    rng = np.random.default_rng(seed)
    nodes, dims = 1 << depth, sample.shape[1]
    directions, cuts = np.zeros((trees, nodes, dims), np.float32), np.zeros((trees, nodes), np.float32)
    for t in range(trees):
        held: dict[int, np.ndarray] = {1: np.arange(len(sample))}
        for node in range(1, nodes):
            own = held.pop(node, np.zeros(0, np.int64))
            d = np.zeros(dims)
            if len(own) > 1:
                a, b = rng.choice(own, 2, replace=False)
                d = sample[a] - sample[b]
            if not d.any():
                d = rng.standard_normal(dims)
            d = (d / np.linalg.norm(d)).astype(np.float32)
            p = sample[own] @ d
            c = np.float32(np.median(p)) if len(own) else np.float32(0)
            directions[t, node], cuts[t, node] = d, c
            held[2 * node], held[2 * node + 1] = own[p <= c], own[p > c]
    return Forest(directions, cuts)
