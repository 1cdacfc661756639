"""Isolation forests of many small sources at once, as plain arrays (Liu, Ting and Zhou 2008).

All trees of all sources of a batch grow together, level by level, so the cost is that of a few array passes and not of
millions of small Python trees. A tree is a complete binary tree of ``depth`` levels in heap order."""

from __future__ import annotations

import numpy as np


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points, c(n) of the paper."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe))


def isolation_scores(x: np.ndarray, source: np.ndarray, n_sources: int, trees: int = 24, sample: int = 64, seed: int = 7) -> np.ndarray:
    """Scores in (0, 1), about 0.5 for ordinary points. ``x``: (rows, features) without NaN, rows of a source together, ``source``: its
    number, ascending. Every source has its own trees, each grown on ``sample`` of its rows drawn with replacement."""
    rows, features = x.shape
    if not rows:
        return np.zeros(0)
    rng = np.random.default_rng(seed)
    depth = max(1, int(np.ceil(np.log2(sample))))
    start = np.searchsorted(source, np.arange(n_sources))
    size = np.searchsorted(source, np.arange(n_sources), side="right") - start
    live = np.flatnonzero(size)
    # one "tree" for each pair of live source and number
    pick = (start[live, None, None] + np.floor(rng.random((len(live), trees, sample)) * size[live, None, None]).astype(np.int64)).reshape(-1)
    tree = np.repeat(np.arange(len(live) * trees), sample)
    nodes = 1 << (depth + 1)
    feature = rng.integers(0, features, (len(live) * trees, nodes)).astype(np.int8)
    cut = np.full((len(live) * trees, nodes), np.inf)  # inf: an end node, or one in which the feature is constant
    held = np.zeros((len(live) * trees, nodes), np.int32)
    node = np.ones(len(pick), np.int64)
    here = np.arange(len(pick))  # points in nodes that may still be split
    for level in range(depth + 1):
        key = tree[here] * nodes + node[here]
        order = np.argsort(key, kind="stable")
        here, key = here[order], key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = key[first]
        count = np.diff(np.r_[first, len(key)])
        held.reshape(-1)[at] = count
        if level == depth:
            break
        value = x[pick[here], feature.reshape(-1)[key]]
        lo, hi = np.minimum.reduceat(value, first), np.maximum.reduceat(value, first)
        # a constant feature cannot split: try the others in turn
        for shift in range(1, features):
            flat = np.flatnonzero((lo == hi) & (count > 1))
            if not len(flat):
                break
            f = (feature.reshape(-1)[at[flat]] + 1) % features
            feature.reshape(-1)[at[flat]] = f
            rows_ = np.concatenate([np.arange(first[i], first[i] + count[i]) for i in flat]) if len(flat) < 64 else np.flatnonzero(np.repeat((lo == hi) & (count > 1), count))
            v = x[pick[here[rows_]], np.repeat(f, count[flat])]
            b = np.r_[0, np.cumsum(count[flat])[:-1]]
            lo[flat], hi[flat] = np.minimum.reduceat(v, b), np.maximum.reduceat(v, b)
            value[rows_] = v
        split = hi > lo
        c = np.where(split, lo + (hi - lo) * rng.random(len(lo)), np.inf)
        c = np.where(split & (c >= hi), lo, c)
        cut.reshape(-1)[at] = c
        go = np.repeat(split, count)
        here, key, value = here[go], key[go], value[go]
        node[here] = 2 * node[here] + (value > cut.reshape(-1)[key])
        if not len(here):
            break
    # end nodes hand their path length down to all leaves below them, so that every row takes the same number of steps
    path = np.zeros((len(live) * trees, nodes), np.float32)
    for level in range(depth + 1):
        a, z = 1 << level, 2 << level
        ends = np.isinf(cut[:, a:z])
        grown = np.repeat(np.isinf(cut[:, a // 2 : a]), 2, axis=1) if level else np.zeros_like(ends)
        above = np.repeat(path[:, a // 2 : a], 2, axis=1) if level else path[:, a:z]
        path[:, a:z] = np.where(grown, above, np.where(ends, level + average_path(held[:, a:z]), 0))
    # score every row in the trees of its source
    number = np.full(n_sources, -1)
    number[live] = np.arange(len(live))
    total = np.zeros(rows)
    base = number[source] * (trees * nodes)
    flat, row = np.ascontiguousarray(x).reshape(-1), np.arange(rows) * features
    cut, feature, path = cut.reshape(-1), feature.reshape(-1), path.reshape(-1)
    for t in range(trees):
        off = base + t * nodes
        cur = np.ones(rows, np.int64)
        for _ in range(depth):
            at = off + cur
            cur += cur
            cur += flat[row + feature[at]] > cut[at]
        total += path[off + cur]
    return 2.0 ** (-(total / trees) / max(average_path(np.array([sample]))[0], 1e-9))
