"""K-prototypes (Huang 1998) over a DataFrame of entities: numeric and categorical features, either of which may be missing.

The distance is the mean squared difference over the observed numeric features (standardised) plus ``gamma`` times the mean mismatch over
the observed categorical ones. Centres: means and modes. Starts come from a bounded sample; every round assigns and averages all entities, until the
assignments stand still: the centres of the same groups are the same."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most entities that choose the first centres; the only step that does not see all of them.
START_SAMPLE = 2000


def _distance(numbers: Sequence[Column], kinds: Sequence[Column], centre: tuple[list, list], gamma: float) -> Column:
    d = F.lit(0.0)
    if numbers:
        parts = [(n, c) for n, c in zip(numbers, centre[0]) if c is not None]
        top = sum((F.coalesce((n - F.lit(float(c))) ** 2, F.lit(0.0)) for n, c in parts), F.lit(0.0))
        d = d + top / F.greatest(sum((n.isNotNull().cast("int") for n, _ in parts), F.lit(0)), F.lit(1))
    if kinds:
        parts = [(k, c) for k, c in zip(kinds, centre[1]) if c is not None]
        top = sum((F.coalesce((k != F.lit(c)).cast("double"), F.lit(0.0)) for k, c in parts), F.lit(0.0))
        d = d + gamma * top / F.greatest(sum((k.isNotNull().cast("int") for k, _ in parts), F.lit(0)), F.lit(1))
    return d


def _nearest(numbers, kinds, centres, gamma) -> Column:
    options = [F.struct(_distance(numbers, kinds, c, gamma).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*options))["i"]


def _settled(x: np.ndarray, kinds: list[list], centres: list[tuple[list, list]], gamma: float, rounds: int) -> list[tuple[list, list]]:
    """Centres of the starting sample, iterated until its assignments stand still: the rounds over all entities then have little left to do."""
    names = [{v: i for i, v in enumerate(sorted({r[j] for r in kinds if r[j] is not None}))} for j in range(len(kinds[0]))] if kinds else []
    code = np.array([[n.get(v, -1) for n, v in zip(names, r)] for r in kinds], np.int64).reshape(len(kinds), len(names))
    there, before = ~np.isnan(x), None
    for _ in range(rounds):
        d = np.zeros((len(x), len(centres)))
        for i, (nums, cats) in enumerate(centres):
            use = np.array([v is not None for v in nums], bool)
            if x.shape[1] and use.any():
                some = there[:, use]
                d[:, i] += np.where(some, (x[:, use] - np.array([v for v in nums if v is not None])) ** 2, 0).sum(axis=1) / np.maximum(some.sum(axis=1), 1)
            want = np.array([n.get(v, -2) for n, v in zip(names, cats)], np.int64)
            if len(names) and (want > -2).any():
                some = (code >= 0)[:, want > -2]
                d[:, i] += gamma * (some & (code[:, want > -2] != want[want > -2])).sum(axis=1) / np.maximum(some.sum(axis=1), 1)
        own = d.argmin(axis=1)
        if before is not None and (own == before).all():
            break
        before = own
        for i in np.unique(own).tolist():
            mine = own == i
            nums = [float(x[mine & there[:, j], j].mean()) if (mine & there[:, j]).any() else None for j in range(x.shape[1])]
            cats = []
            for j, n in enumerate(names):
                held = np.bincount(code[mine & (code[:, j] >= 0), j], minlength=len(n))
                cats.append(list(n)[int(held.argmax())] if held.any() else None)
            centres[i] = nums, cats
    return centres


def kprototypes(entities: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int, rounds: int = 200, gamma: float = 1.0, key: str = "source") -> DataFrame:
    """``entities`` with an int column ``cluster``. ``entities`` is read several times: cut its lineage first. Empty input gives none. ``rounds`` only
    ends a cycle of ties; without one the costs fall until nothing moves."""
    stats = entities.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(f"n{i}") for i, c in enumerate(numeric)], F.count("*").alias("n")).first()
    if not stats["n"]:
        return entities.withColumn("cluster", F.lit(0))
    numbers = [(F.col(c) - F.lit(float(stats[f"n{i}"]["m"] or 0))) / F.lit(float(stats[f"n{i}"]["s"] or 0) or 1.0) for i, c in enumerate(numeric)]
    kinds = [F.col(c) for c in categorical]
    start = entities.orderBy(F.xxhash64(key), F.col(key)).limit(START_SAMPLE).select(*[n.alias(f"n{i}") for i, n in enumerate(numbers)], *[c.alias(f"c{i}") for i, c in enumerate(kinds)]).collect()
    x = np.array([[r[f"n{i}"] if r[f"n{i}"] is not None else np.nan for i in range(len(numbers))] for r in start], float).reshape(len(start), len(numbers))
    c = [[r[f"c{i}"] for i in range(len(kinds))] for r in start]

    def far(j: int) -> np.ndarray:
        with np.errstate(all="ignore"):
            d = np.nan_to_num(np.nansum((x - x[j]) ** 2, axis=1) / max(len(numbers), 1))
        return d + gamma * np.array([sum(a is not None and b is not None and a != b for a, b in zip(row, c[j])) / max(len(kinds), 1) for row in c])

    rng, chosen = np.random.default_rng(11), [0]
    least = far(0)
    while len(chosen) < min(k, len(start)) and least.sum() > 0:
        chosen.append(int(rng.choice(len(start), p=least / least.sum())))
        least = np.minimum(least, far(chosen[-1]))
    centres = _settled(x, c, [([None if np.isnan(v) else float(v) for v in x[j]], c[j]) for j in chosen], gamma, rounds)
    for _ in range(rounds):
        got = entities.select(_nearest(numbers, kinds, centres, gamma).alias("i"), *[n.alias(f"n{j}") for j, n in enumerate(numbers)], *[c_.alias(f"c{j}") for j, c_ in enumerate(kinds)])
        got = got.groupBy("i").agg(*[F.avg(f"n{j}").alias(f"n{j}") for j in range(len(numbers))], *[F.mode(f"c{j}", deterministic=True).alias(f"c{j}") for j in range(len(kinds))], F.lit(1).alias("_"))
        new = {r["i"]: ([r[f"n{j}"] for j in range(len(numbers))], [r[f"c{j}"] for j in range(len(kinds))]) for r in got.collect()}  # k rows
        new = [new.get(i, old) for i, old in enumerate(centres)]
        still = all(a[1] == b[1] and all(x == y or None not in (x, y) and abs(x - y) <= 1e-9 * (1 + abs(x)) for x, y in zip(a[0], b[0])) for a, b in zip(new, centres))
        centres = new
        if still:
            break
    return entities.withColumn("cluster", _nearest(numbers, kinds, centres, gamma))
