"""Irregular readings onto a regular daily grid, by shape-preserving monotone cubic interpolation.

Readings of a calendar day add up. Days between two observed days are filled by the monotone cubic through the observed day
totals (slopes by the weighted harmonic mean of Fritsch and Butland, so no fill leaves the range of its two neighbours); gaps
of more than ``max_gap`` days stay null and marked, and no slope reaches across them. Each time shard gets two halo days from either side,
and every span between two observed days is filled by the shard of its left end.

Defined results: a reading is usable if source, time and value are neither null nor NaN; re-delivered readings (same source, time and value)
count once; a source with one usable day has one row; empty tables give empty grids; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.common import col, day_number, from_day, present, require
from tidegrid.operators.shards import sharded

SHARD_DAYS = 64


def _inner(h0: Column, d0: Column, h1: Column, d1: Column) -> Column:
    """Slope at a knot between two spans of lengths h and slopes d."""
    w0, w1 = 2 * h1 + h0, h1 + 2 * h0
    return F.when(d0 * d1 <= 0, F.lit(0.0)).otherwise((w0 + w1) / (w0 / F.nullif(d0, F.lit(0.0)) + w1 / F.nullif(d1, F.lit(0.0))))


def _end(h0: Column, d0: Column, h1: Column, d1: Column) -> Column:
    """Slope at an end: of the parabola through three knots, kept within the shape. h0, d0: the span at the end."""
    s = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
    return F.when(s * d0 <= 0, F.lit(0.0)).when((d0 * d1 < 0) & (F.abs(s) > 3 * F.abs(d0)), 3 * d0).otherwise(s)


def monotone_cubic(x: Column, p: list[tuple[Column, Column]]) -> Column:
    """The value at x between knots p[1] and p[2]; p[0] and p[3] are their neighbours, null where there are none."""
    h = [p[i + 1][0] - p[i][0] for i in range(3)]
    d = [(p[i + 1][1] - p[i][1]) / h[i] for i in range(3)]
    left = F.when(d[0].isNotNull(), _inner(h[0], d[0], h[1], d[1])).when(d[2].isNotNull(), _end(h[1], d[1], h[2], d[2])).otherwise(d[1])
    right = F.when(d[2].isNotNull(), _inner(h[1], d[1], h[2], d[2])).when(d[0].isNotNull(), _end(h[1], d[1], h[0], d[0])).otherwise(d[1])
    t = (x - p[1][0]) / h[1]
    return (1 + 2 * t) * (1 - t) ** 2 * p[1][1] + t * (1 - t) ** 2 * h[1] * left + t * t * (3 - 2 * t) * p[2][1] + t * t * (t - 1) * h[1] * right


def regular_days(df: DataFrame, source: str, time: str, value: str, max_gap: int = 7) -> DataFrame:
    """(source, day, value, n_readings, status) for each calendar day from a source's first to its last usable reading;
    status is ``observed``, ``filled`` or ``gap`` (value null). Plan: three exchanges (readings, days, one row a shard), no Python."""
    require(df, source, time, value)
    if max_gap < 0:
        raise ValueError("max_gap must not be negative")
    use = df.where(col(source).isNotNull() & present(df, time) & present(df, value))
    use = use.select(col(source).cast("string").alias("source"), col(time).alias("t"), col(value).cast("double").alias("v")).distinct()
    days = use.groupBy("source", day_number(F.col("t")).alias("day")).agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    s = sharded(days.select("source", "day", F.struct("day", "v", "n").alias("item")), "item", SHARD_DAYS, 2, 2)
    s = s.select("source", F.size("before").alias("k"), F.size("own").alias("m"), F.concat("before", "own", "after").alias("a"))
    at = lambda j: F.get("a", F.col("k") + F.col("i") + j)
    s = s.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i")).select("source", *[at(j).alias(f"p{j + 1}") for j in (-1, 0, 1, 2)])
    near = lambda a, b: F.col(f"{b}.day") - F.col(f"{a}.day") - 1 <= max_gap
    s = s.withColumns({"p0": F.when(near("p0", "p1"), F.col("p0")), "p3": F.when(near("p2", "p3"), F.col("p3"))})
    s = s.select("*", F.explode(F.sequence("p1.day", F.coalesce(F.col("p2.day") - 1, F.col("p1.day")))).alias("day"))
    seen, near_ = F.col("day") == F.col("p1.day"), near("p1", "p2")
    cubic = monotone_cubic(F.col("day").cast("double"), [(F.col(f"p{i}.day").cast("double"), F.col(f"p{i}.v")) for i in range(4)])
    return s.select(
        F.col("source").alias(source), from_day(F.col("day")).alias("day"), F.when(seen, F.col("p1.v")).when(near_, cubic).alias(value),
        F.when(seen, F.col("p1.n")).otherwise(F.lit(0)).alias("n_readings"), F.when(seen, "observed").when(near_, "filled").otherwise("gap").alias("status"),
    )
