"""Time shards with a halo: the way every per-series kernel here reads a series of any length.

The rows of a source are cut by calendar into shards of ``shard_days``; each shard is one array, sorted by time, and gets the
last and first ``halo`` rows of the shards around it. No source is ever gathered into one task: what moves by source
alone is one row a shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sharded(rows: DataFrame, item: str, shard_days: int, halo: int, reach: int, extra: dict | None = None, also: Callable[[Column], Column] | None = None) -> DataFrame:
    """``rows``: (source, day int, item struct that sorts by time first), no two items equal. Gives (source, shard, own, before, after):
    before and after hold up to ``halo`` items each, from up to ``reach`` shards that have rows on either side; reach >= halo is exact
    however thin the shards are. ``extra``: further aggregates of a shard, by name. ``also``: a condition on items; before and after then hold, beside these,
    the last and first ``halo`` items that meet it, from however many shards away."""
    shard = F.floor(F.col("day") / shard_days).cast("int").alias("shard")
    s = rows.groupBy("source", shard).agg(F.array_sort(F.collect_list(item)).alias("own"), *[c.alias(k) for k, c in (extra or {}).items()])
    by = Window.partitionBy("source").orderBy("shard")
    none = F.filter("own", lambda _: F.lit(False))
    tail, head = F.slice("own", -F.least(F.lit(halo), F.size("own")), F.lit(halo)), F.slice("own", 1, halo)
    s = s.select("*", tail.alias("_tail"), head.alias("_head"))
    before = F.concat(*[F.coalesce(F.lag("_tail", k).over(by), none) for k in range(reach, 0, -1)])
    after = F.concat(*[F.coalesce(F.lead("_head", k).over(by), none) for k in range(1, reach + 1)])
    s = s.select("*", before.alias("_b"), after.alias("after"))
    last = lambda c: F.when(F.size(c) > halo, F.slice(c, -halo, halo)).otherwise(F.col(c))
    s = s.withColumns({"before": last("_b"), "after": F.slice("after", 1, halo)}).drop("_b", "_tail", "_head")
    if also is None:
        return s
    some = F.filter("own", also)
    s = s.withColumns({"_tail": F.when(F.size(some) > 0, F.slice(some, -F.least(F.lit(halo), F.size(some)), F.lit(halo))), "_head": F.when(F.size(some) > 0, F.slice(some, 1, halo))})
    near = lambda what, k: F.coalesce(F.expr(f"{what}, {k}) ignore nulls over (partition by source order by shard)"), none)
    s = s.withColumns({"_b": F.concat(*[near("lag(_tail", k) for k in range(halo, 0, -1)]), "_a": F.concat(*[near("lead(_head", k) for k in range(1, halo + 1)])})
    return s.withColumns({"before": F.array_sort(F.array_union("before", last("_b"))), "after": F.array_sort(F.array_union("after", F.slice("_a", 1, halo)))}).drop("_a", "_b", "_tail", "_head")
