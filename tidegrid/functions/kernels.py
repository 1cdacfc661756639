"""Numerical kernels of single series, numpy only: splines, Box-Cox likelihood, seasonal-trend decomposition by loess, linear exponential smoothing."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np


# splines

def _basis(t: np.ndarray, k: int, x: np.ndarray) -> np.ndarray:
    """Values of all B-splines of degree k with knots t at x, by the recursion of Cox and de Boor."""
    spans = len(t) - 1
    last = np.searchsorted(t, t[-1]) - 1  # the last span with a length holds its right end
    at = np.clip(np.searchsorted(t, x, side="right") - 1, 0, last)
    b = np.zeros((len(x), spans))
    b[np.arange(len(x)), at] = 1.0
    for d in range(1, k + 1):
        n = spans - d
        with np.errstate(all="ignore"):
            left = (x[:, None] - t[None, :n]) / (t[d : d + n] - t[:n])
            right = (t[None, d + 1 : d + 1 + n] - x[:, None]) / (t[d + 1 : d + 1 + n] - t[1 : 1 + n])
        b = np.nan_to_num(left, posinf=0, neginf=0) * b[:, :n] + np.nan_to_num(right, posinf=0, neginf=0) * b[:, 1 : n + 1]
    return b


def interpolating_spline(x: np.ndarray, y: np.ndarray, order: int) -> Callable[[np.ndarray], np.ndarray]:
    """Through all points, not-a-knot. Needs order + 1 points."""
    if order % 2:
        inner = x[(order + 1) // 2 : -(order + 1) // 2]
    else:
        mid = (x[1:] + x[:-1]) / 2
        inner = mid[order // 2 : len(mid) - order // 2]
    t = np.r_[[x[0]] * (order + 1), inner, [x[-1]] * (order + 1)]
    c = np.linalg.solve(_basis(t, order, x), y)
    return lambda at: _basis(t, order, np.asarray(at, float)) @ c


def smoothing_spline(x: np.ndarray, y: np.ndarray, order: int, s: float | None = None) -> Callable[[np.ndarray], np.ndarray]:
    """A least-squares spline with few knots whose squared residuals sum to at most s (default: the number of points). Knots are added where the residuals are
    largest. Past the ends the last polynomial goes on."""
    s = float(len(x)) if s is None else s
    inner = np.zeros(0)
    while True:
        t = np.r_[[x[0]] * (order + 1), inner, [x[-1]] * (order + 1)]
        b = _basis(t, order, x)
        c, *_ = np.linalg.lstsq(b, y, rcond=None)
        r2 = (y - b @ c) ** 2
        if r2.sum() <= s or len(inner) >= len(x) - order - 1:
            break
        edges = np.r_[x[0], inner, x[-1]]
        part = np.clip(np.searchsorted(edges, x, side="right") - 1, 0, len(edges) - 2)
        worst = np.bincount(part, r2, len(edges) - 1)
        added = []
        for p in np.argsort(-worst)[: max(1, len(worst) // 2)]:  # several at once, as their number is found by doubling
            own = x[part == p]
            if len(own) > 2 and x[0] < own[len(own) // 2] < x[-1]:
                added.append(own[len(own) // 2])
        added = np.setdiff1d(added, inner)[: len(x) - order - 1 - len(inner)]
        if not len(added):
            break
        inner = np.sort(np.r_[inner, added])

    def at(z: np.ndarray) -> np.ndarray:
        z = np.asarray(z, float)
        out = _basis(t, order, np.clip(z, x[0], x[-1])) @ c
        for side, far in ((x[0], z < x[0]), (x[-1], z > x[-1])):
            if far.any():  # the polynomial of the end span, from order + 1 of its points
                width = (inner[0] - x[0] if side == x[0] else x[-1] - inner[-1]) if len(inner) else x[-1] - x[0]
                p = side + np.linspace(0, width if side == x[0] else -width, order + 1)
                out[far] = np.polyval(np.polyfit(p - side, _basis(t, order, p) @ c, order), z[far] - side)
        return out

    return at


# Box-Cox

def boxcox(y: np.ndarray, lam: float) -> np.ndarray:
    return np.log(y) if abs(lam) < 1e-12 else np.expm1(lam * np.log(y)) / lam


def boxcox_lambda(y: np.ndarray, low: float = -5.0, high: float = 5.0) -> float:
    """The exponent of greatest likelihood, by golden section after a coarse look."""
    log = np.log(y)
    total, n = log.sum(), len(y)

    def loss(lam: float) -> float:
        z = boxcox(y, lam)
        v = z.var()
        return -((lam - 1) * total - n / 2 * np.log(v)) if v > 0 and np.isfinite(v) else np.inf

    grid = np.linspace(low, high, 41)
    i = int(np.argmin([loss(g) for g in grid]))
    a, b = grid[max(i - 1, 0)], grid[min(i + 1, len(grid) - 1)]
    ratio = (np.sqrt(5) - 1) / 2
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = loss(c), loss(d)
    while b - a > 1e-9:
        if fc < fd:
            b, d, fd = d, c, fc
            c = b - ratio * (b - a)
            fc = loss(c)
        else:
            a, c, fc = c, d, fd
            d = a + ratio * (b - a)
            fd = loss(d)
    return float((a + b) / 2)


# seasonal-trend decomposition (Cleveland, Cleveland, McRae and Terpenning 1990)

@lru_cache(64)
def _windows(n: int, span: int, first: float, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours and tricube weights for local fits at ``count`` places from ``first`` on, of n evenly spaced values. They depend on no data."""
    at = first + np.arange(count, dtype=float)
    q = min(span, n)
    begin = np.clip(np.round(at).astype(int) - q // 2, 0, n - q)
    near = begin[:, None] + np.arange(q)
    gap = np.abs(near - at[:, None])
    reach = gap.max(axis=1) + max(0, (span - n) // 2)
    w = np.clip(1 - (gap / np.maximum(reach, 1e-12)[:, None] * 0.999) ** 3, 0, None) ** 3
    return near, w, near - at[:, None]


@lru_cache(64)
def _smoother(n: int, span: int) -> np.ndarray:
    """The local linear fit at all n places without robust weights, which is a matrix."""
    return _loess(np.eye(n), span, 0.0, n, np.ones((1, n))).T


def _loess(y: np.ndarray, span: int, first: float, count: int, robust: np.ndarray) -> np.ndarray:
    """Local linear fits of the rows of y, which are evenly spaced; tricube weights times ``robust``. In moments around each place, so that one product a moment does."""
    near, w, off = _windows(y.shape[1], span, first, count)
    w = w * robust[:, near]
    v = y[:, near]
    wo = w * off
    s0, s1, s2 = w.sum(axis=2), wo.sum(axis=2), (wo * off).sum(axis=2)
    t0, t1 = (w * v).sum(axis=2), (wo * v).sum(axis=2)
    det = s0 * s2 - s1 * s1
    flat = det <= 1e-12 * np.maximum(s0 * s2, 1e-300)
    return np.where(flat, t0 / np.maximum(s0, 1e-300), (s2 * t0 - s1 * t1) / np.where(flat, 1, det))


def _mean(y: np.ndarray, k: int) -> np.ndarray:
    c = np.cumsum(np.r_[0.0, y])
    return (c[k:] - c[:-k]) / k


def stl(y: np.ndarray, period: int, seasonal: int = 13, robust: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seasonal, trend, remainder). Needs two full periods."""
    n = len(y)
    if n < 2 * period:
        raise ValueError(f"{n} values are fewer than two periods of {period}")
    odd = lambda v: int(np.ceil(v)) + (int(np.ceil(v)) + 1) % 2
    trend_span, low_span = odd(1.5 * period / (1 - 1.5 / seasonal)), odd(period + (period + 1) % 2)
    plain = True  # until there are robust weights
    rows = -(-n // period)
    weights, trend = np.ones(n), np.zeros(n)
    for _ in range(15 if robust else 1):
        for _ in range(2 if robust else 5):
            d = y - trend
            cycle = np.zeros((rows + 2) * period)
            # the series of each phase, of one of two lengths
            for m in {n // period, rows}:
                phases = np.array([p for p in range(period) if len(range(p, n, period)) == m])
                if not m or not len(phases):
                    continue
                idx = phases[:, None] + period * np.arange(m)
                c = _loess(d[idx], seasonal, -1.0, m + 2, weights[idx])
                cycle[(phases[:, None] + period * np.arange(m + 2)).reshape(-1)] = c.reshape(-1)
            cycle = cycle[: n + 2 * period]
            low = _mean(_mean(_mean(cycle, period), period), 3)
            low = _smoother(n, low_span) @ low
            season = cycle[period : period + n] - low
            trend = _smoother(n, trend_span) @ (y - season) if plain else _loess((y - season)[None], trend_span, 0.0, n, weights[None])[0]
        rest = y - season - trend
        if robust:
            h = 6 * np.median(np.abs(rest))
            weights = np.clip(1 - (np.abs(rest) / h) ** 2, 0, None) ** 2 if h > 0 else np.ones(n)
            weights, plain = np.maximum(weights, 1e-6), False
    return season, trend, y - season - trend


# linear exponential smoothing (Holt)

def holt(y: np.ndarray, horizon: int, alpha: float | None = None) -> np.ndarray:
    """Forecasts with an additive trend. The smoothing weights of least squared one-step error, found on grids that narrow; a given alpha stays fixed. All grid points run at once."""
    n = len(y)
    if n == 1:
        return np.repeat(y, horizon)
    k = min(n, 10)
    slope, level = np.polyfit(np.arange(k), y[:k], 1) if k > 2 else (y[1] - y[0], y[0])
    lo, hi = np.array([1e-4, 1e-4]), np.array([0.9999, 0.9999])
    for _ in range(4):
        a = np.array([alpha]) if alpha is not None else np.linspace(lo[0], hi[0], 15)
        b = np.linspace(lo[1], hi[1], 15)
        aa, bb = (g.reshape(-1) for g in np.meshgrid(a, b, indexing="ij"))
        lev, tr, sse = np.full(len(aa), level - slope), np.full(len(aa), slope), np.zeros(len(aa))
        for v in y:
            guess = lev + tr
            e = v - guess
            sse += e * e
            new = guess + aa * e
            tr = tr + aa * bb * e
            lev = new
        i = int(np.argmin(sse))
        best = aa[i], bb[i], lev[i], tr[i]
        width = (hi - lo) / 7
        lo, hi = np.clip(np.array(best[:2]) - width, 1e-4, 0.9999), np.clip(np.array(best[:2]) + width, 1e-4, 0.9999)
    return best[2] + best[3] * np.arange(1, horizon + 1)
