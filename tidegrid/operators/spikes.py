"""Implausible readings: physical limits, spikes and stuck values, scored by one isolation forest per source and time shard.

Every reading is described by four features relative to its own source: its level (log of the ratio to the median of its
``NEAR`` neighbours on either side), its difference from the reading before, its seasonal remainder (level against the same
weekday's usual level) and the length of the run of equal values it is in. Forests score all readings and propose those that score at least
``threshold``; of these the ones ``TIMES`` off their level are spikes, and no other reading is, whatever its level. Explicit physical rules stand beside the score: impossible signs, and
``RUN`` equal readings in a row of a source that otherwise changes.

Defined results: null and NaN values are no readings; rows with a null source or time are left out; a reading that is delivered
several times (same source, time and value) counts once, and all its rows share the verdict; equal times are ordered by value;
an infinite value is a spike; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import col, day_number, present, require
from tidegrid.functions.forest import isolation_scores
from tidegrid.operators.shards import sharded

SHARD_DAYS, NEAR, RUN, TIMES = 512, 7, 6, 3.0
#: Readings that score below are no spikes. Of 4.2 million readings the 20,376 that are three times off their level score 0.537 or more, 73 % of the others less than 0.5.
THRESHOLD = 0.5


def run_lengths(v: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Length of the run of equal values of the same piece that each position is in."""
    n = len(v)
    if not n:
        return np.zeros(0, np.int64)
    new = np.r_[True, (v[1:] != v[:-1]) | (piece[1:] != piece[:-1])]
    first = np.flatnonzero(new)
    return np.repeat(np.diff(np.r_[first, n]), np.diff(np.r_[first, n]))


def levels(v: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Median of the positive values among the NEAR nearest positive readings on either side, itself excluded; NaN if there are none."""
    out = np.full(len(v), np.nan)
    ok = np.flatnonzero(v > 0)
    if not len(ok):
        return out
    # positive readings only: zeros and impossible values are not part of the level
    size = np.bincount(piece[ok], minlength=piece[-1] + 1)
    pad = np.full(len(ok) + 2 * NEAR * len(size), np.nan)
    at = np.arange(len(ok)) + (2 * piece[ok] + 1) * NEAR
    pad[at] = v[ok]
    view = np.lib.stride_tricks.sliding_window_view(pad, 2 * NEAR + 1)
    for b in range(0, len(ok), 200_000):
        w = np.sort(np.delete(view[at[b : b + 200_000] - NEAR], NEAR, axis=1), axis=1)  # NaN last
        n = (~np.isnan(w)).sum(axis=1)
        r = np.arange(len(w))
        out[ok[b : b + 200_000]] = np.where(n > 0, (w[r, np.maximum(n - 1, 0) // 2] + w[r, np.minimum(n // 2, w.shape[1] - 1)]) / 2, np.nan)
    return out


def group_medians(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    order = np.lexsort((x, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    n = np.diff(np.r_[first, len(g)])
    med = (x[order][first + (n - 1) // 2] + x[order][first + n // 2]) / 2
    out = np.empty(len(x))
    out[order] = np.repeat(med, n)
    return out


def judge(v: np.ndarray, day: np.ndarray, piece: np.ndarray, moves: np.ndarray, own: np.ndarray, zero_ok: bool, threshold: float) -> dict[str, np.ndarray]:
    """v, day, piece: readings with their halos, by piece and time. moves: by piece, whether the whole source has more than one value.
    own: which readings belong to the piece itself. Returns levels, runs, scores and kinds for all; kind '' is no case."""
    run = run_lengths(v, piece)
    level = levels(v, piece)
    positive = v > 0
    with np.errstate(all="ignore"):
        log = np.where(positive, np.log(np.where(positive, v, 1.0)), 0.0)
        ratio = np.where(positive & (level > 0), np.clip(log - np.log(level), -12, 12), 0.0)
        # the last positive reading before
        idx = np.where(positive, np.arange(len(v)), -1)
        before = np.r_[-1, np.maximum.accumulate(idx)[:-1]] if len(v) else idx
        same = (before >= 0) & positive & (piece[np.maximum(before, 0)] == piece)
        diff = np.where(same, np.clip(log - log[np.maximum(before, 0)], -12, 12), 0.0)
    season = ratio - group_medians(ratio, piece * 7 + day % 7) if len(v) else ratio
    x = np.stack([ratio, diff, season, np.log2(np.where(v == 0, 1, run))], axis=1)
    score = np.zeros(len(v))
    o = np.flatnonzero(own)
    score[o] = isolation_scores(x[o], piece[o], len(moves))
    limit = (v < 0) | ((v == 0) & (not zero_ok))
    suspect = (score >= threshold) & ~limit
    with np.errstate(all="ignore"):
        spike = suspect & positive & ((v > TIMES * level) | (v * TIMES < level) | np.isinf(v))
    stuck = ~limit & (run >= RUN) & (v != 0) & moves[piece]
    return {"level": level, "run": run, "score": score, "kind": np.where(limit, "impossible", np.where(spike, "spike", np.where(stuck, "frozen", "")))}


def readings(df: DataFrame, source: str, time: str, value: str) -> DataFrame:
    use = df.where(col(source).isNotNull() & present(df, time) & present(df, value))
    return use.select(col(source).cast("string").alias("source"), col(time).alias("t"), (col(value).cast("double") + 0.0).alias("v"))


def score_readings(df: DataFrame, source: str, time: str, value: str, zero_ok: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """(source, t, v, level, run, score, kind): every distinct reading with its score; kind is impossible, spike, frozen or ''.

    Plan: readings are made distinct map-side first, then one exchange gathers time shards (at most SHARD_DAYS days of one source) and one moves
    them by source for their halos; one Arrow pass judges many shards at a time."""
    require(df, source, time, value)
    rows = readings(df, source, time, value).distinct().select("source", day_number(F.col("t")).alias("day"), F.struct("t", "v").alias("item"))
    s = sharded(rows, "item", SHARD_DAYS, NEAR, NEAR, {"lo": F.min("item.v"), "hi": F.max("item.v")}, also=lambda x: x["v"] > 0)  # runs need the nearest readings, levels the nearest positive ones
    w = Window.partitionBy("source")
    s = s.select("source", "before", "own", "after", (F.min("lo").over(w) < F.max("hi").over(w)).alias("moves"))
    kind = rows.schema["item"].dataType["t"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                parts = [b[c] for c in ("before", "own", "after")]
                sizes = np.stack([p.value_lengths().to_numpy(zero_copy_only=False) for p in parts], axis=1)
                # interleave: before, own, after of each shard
                flat = pa.concat_arrays([p.flatten() for p in parts])
                base = np.array([0, sizes[:, 0].sum(), sizes[:, :2].sum()])
                begin = base + np.cumsum(sizes, axis=0) - sizes
                n = sizes.reshape(-1)
                take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin.reshape(-1), n)
                flat = flat.take(pa.array(take))
                piece = np.repeat(np.arange(b.num_rows), sizes.sum(axis=1))
                own = np.repeat(np.tile([False, True, False], b.num_rows), n)
                t = flat.field("t")
                day = t.cast(pa.timestamp("us")).cast(pa.int64()).to_numpy(zero_copy_only=False) // 86_400_000_000
                v = flat.field("v").to_numpy(zero_copy_only=False)
                got = judge(v, day, piece, b["moves"].to_numpy(zero_copy_only=False).astype(bool), own, zero_ok, threshold)
                o = pa.array(np.flatnonzero(own))
                yield pa.RecordBatch.from_pydict({
                    "source": b["source"].take(pa.array(piece[own])), "t": t.take(o), "v": pa.array(v[own]), "level": pa.array(got["level"][own], from_pandas=True),
                    "run": pa.array(got["run"][own].astype(np.int32)), "score": pa.array(got["score"][own]), "kind": pa.array(got["kind"][own]),
                })

    return s.mapInArrow(run, f"source string, t {kind}, v double, level double, run int, score double, kind string")


def implausible_rows(df: DataFrame, source: str, time: str, value: str, key: str, zero_ok: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """(key, source, t, v, level, score, kind): the rows of ``df`` whose reading is a case, all deliveries of it."""
    require(df, key)
    bad = score_readings(df, source, time, value, zero_ok, threshold).where("kind <> ''").drop("run")
    rows = df.where(col(source).isNotNull() & present(df, time) & present(df, value)).select(col(key).alias("row_key"), col(source).cast("string").alias("source"), col(time).alias("t"), (col(value).cast("double") + 0.0).alias("v"))
    return rows.join(bad, ["source", "t", "v"]).distinct()
