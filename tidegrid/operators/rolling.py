"""Rolling totals over trailing periods, answered by segment trees.

Every entity's calendar is cut into time shards of ``SHARD_DAYS`` days. A shard holds one segment tree in heap order:
node 1 is the whole shard, node ``SHARD_DAYS + i`` its day ``i``; every node stores the sum and the count of the present
values below it. A trailing period is answered by O(log SHARD_DAYS) nodes of the shards in which it begins and ends, and by the
roots of those between. A late correction changes one leaf and its ancestors, in one shard; trees can be stored, corrected and queried.

Defined results: null and NaN values count as absent (they add nothing), zero is present; rows that repeat in all read
columns (``row_key`` included) count once; rows with a null entity or day are left out; a day without a present value has
total 0, count 0 and a null average; an empty table gives an empty result. Other columns of the table are never read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.common import col, day_number, from_day, present, require

SHARD_DAYS = 64


def daily_totals(df: DataFrame, entity: str, day: str, value: str, row_key: Sequence[str] = ()) -> DataFrame:
    """(entity, day int, s, c): one row per entity and calendar day that has any row. Duplicates fall away map-side first,
    then the days are pre-aggregated, so that neither copies nor a hot entity reach one task."""
    require(df, entity, day, value, *row_key)
    rows = df.select(
        col(entity).cast("string").alias("entity"), day_number(col(day)).alias("day"),
        F.when(present(df, value), col(value).cast("double")).alias("v"), *[col(k).alias(f"k{i}") for i, k in enumerate(row_key)],
    ).where("entity is not null and day is not null")
    return rows.distinct().groupBy("entity", "day").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("s"), F.count("v").cast("int").alias("c"))


def reach(period: int) -> list[int]:
    """How many shards back a trailing period of a day of this shard may begin."""
    return list(range(-(-max(period - SHARD_DAYS, 0) // SHARD_DAYS), -(-(period - 1) // SHARD_DAYS) + 1))


def with_before(shards: DataFrame, trees: Sequence[str], roots: dict[str, Column], periods: Sequence[int]) -> DataFrame:
    """(entity, shard, *trees, first, last, and by k the trees ``{tree}_k`` of the shard k before and the sums ``{root}_k`` of the roots in between): one row per shard of the calendar
    from the entity's first to its last, shards without rows included, with the days of the entity's span that lie in it. ``shards`` has lo and hi, its first and last day."""
    w = Window.partitionBy("entity")
    by = w.orderBy("shard")
    got = shards.select("*", *[r.alias(n) for n, r in roots.items()], F.min("lo").over(w).alias("start"), F.max("hi").over(w).alias("end"), F.coalesce(F.lead("shard").over(by) - 1, F.col("shard")).alias("until"))
    got = got.select("*", F.posexplode(F.sequence("shard", "until")).alias("step", "at"))
    here = [F.when(F.col("step") == 0, F.col(t)).alias(t) for t in trees] + [F.when(F.col("step") == 0, F.col(n)).alias(n) for n in roots]
    got = got.select("entity", F.col("at").alias("shard"), *here, F.greatest(F.col("at") * SHARD_DAYS, "start").cast("int").alias("first"), F.least(F.col("at") * SHARD_DAYS + SHARD_DAYS - 1, "end").cast("int").alias("last"))
    more = []
    for k in sorted({k for p in periods for k in reach(p)} - {0}):
        more += [F.first(t).over(by.rangeBetween(-k, -k)).alias(f"{t}_{k}") for t in trees]
        more += [(F.coalesce(F.sum(n).over(by.rangeBetween(1 - k, -1)), F.lit(0)) if k > 1 else F.lit(0)).cast("double" if n == "root_s" else "bigint").alias(f"{n}_{k}") for n in roots]
    return got.select("*", *more)


def shard_leaves(daily: DataFrame, periods: Sequence[int]) -> DataFrame:
    shard = F.floor(F.col("day") / SHARD_DAYS).cast("int")
    leaves = daily.groupBy("entity", shard.alias("shard")).agg(
        F.collect_list(F.struct("day", "s", "c")).alias("leaves"), F.min("day").alias("lo"), F.max("day").alias("hi"), F.sum("s").alias("all_s"), F.sum("c").alias("all_c")
    )
    return with_before(leaves, ["leaves"], {"root_s": F.col("all_s"), "root_c": F.col("all_c")}, periods)


def build(leaves: np.ndarray) -> np.ndarray:
    """Trees in heap order, (n, 2 * size), from leaves (n, size)."""
    n, size = leaves.shape
    tree = np.zeros((n, 2 * size), leaves.dtype)
    tree[:, size:] = leaves
    while size > 1:
        half = size // 2
        tree[:, half:size] = tree[:, size : 2 * size : 2] + tree[:, size + 1 : 2 * size : 2]
        size = half
    return tree


def query(tree: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums over leaves lo..hi (inclusive; empty where hi < lo) of the trees named by row, climbing from the leaves."""
    size = tree.shape[1] // 2
    left, right, total = lo + size, hi + size + 1, np.zeros(len(row), tree.dtype)
    while (open_ := left < right).any():
        take = open_ & (left & 1 == 1)
        total[take] += tree[row[take], left[take]]
        left = (left + take) >> 1
        take = open_ & (right & 1 == 1)
        right = right - take
        total[take] += tree[row[take], right[take]]
        right >>= 1
    return total


def _scatter(lists: pa.ListArray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (sums, counts) of one tree per list; a null or empty list is a tree of zeros."""
    at = lists.offsets.to_numpy()
    size = np.diff(at)
    flat = lists.values.slice(at[0], at[-1] - at[0]) if len(at) else lists.values
    row = np.repeat(np.arange(len(size)), size)
    s, c = np.zeros((len(size), SHARD_DAYS)), np.zeros((len(size), SHARD_DAYS), np.int64)
    if len(row):
        i = flat.field("day").to_numpy(zero_copy_only=False) - shard[row] * SHARD_DAYS
        s[row, i], c[row, i] = flat.field("s").to_numpy(zero_copy_only=False), flat.field("c").to_numpy(zero_copy_only=False)
    return s, c


def _whole(lists: pa.Array) -> pa.ListArray:
    """Without nulls whose hidden ranges would have a length."""
    return pa.concat_arrays([lists]) if lists.null_count == 0 else lists.take(pa.array(range(len(lists)))).fill_null([])


def trees_of(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the shards k before those of the batch, built from their leaves or as they are stored; a missing tree is one of zeros."""
    end = f"_{k}" if k else ""
    if f"leaves{end}" in batch.schema.names:
        return tuple(map(build, _scatter(_whole(batch[f"leaves{end}"]), batch["shard"].to_numpy() - k)))
    return tuple(_stored(batch[f"{c}{end}"], kind) for c, kind in (("sums", float), ("counts", np.int64)))


def _stored(lists: pa.Array, kind: type) -> np.ndarray:
    out = np.zeros((len(lists), 2 * SHARD_DAYS), kind)
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    if there.any():
        out[there] = lists.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * SHARD_DAYS)
    return out


def answer(batch: pa.RecordBatch, periods: Sequence[int]) -> dict[str, np.ndarray | pa.Array]:
    """One row per shard and day of it."""
    shard = batch["shard"].to_numpy()
    trees = {k: trees_of(batch, k) for k in sorted({0} | {k for p in periods for k in reach(p)})}
    first, last = batch["first"].to_numpy(), batch["last"].to_numpy()
    n = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    day = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[row]
    rel = day - shard[row] * SHARD_DAYS
    out: dict = {"entity": batch["entity"].take(pa.array(row)), "day": day.astype(np.int32)}
    for p in periods:
        short = p - 1 - rel  # days of the period before this shard
        back = np.maximum(-(-short // SHARD_DAYS), 0)
        for i, what in enumerate(("total", "count")):
            got = query(trees[0][i], row, np.maximum(rel - p + 1, 0), rel)
            for k in reach(p):
                if k and len(at := np.flatnonzero(back == k)):
                    between = batch[f"root_{'sc'[i]}_{k}"].to_numpy(zero_copy_only=False)
                    got[at] += between[row[at]] + query(trees[k][i], row[at], k * SHARD_DAYS - short[at], np.full(len(at), SHARD_DAYS - 1))
            out[f"{what}_{p}"] = got
    return out


def _answers(shards: DataFrame, periods: Sequence[int]) -> DataFrame:
    kinds = [T.StructField("entity", T.StringType()), T.StructField("day", T.IntegerType())]
    for p in periods:
        kinds += [T.StructField(f"total_{p}", T.DoubleType()), T.StructField(f"count_{p}", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):  # bounds the answers held at once
                yield pa.RecordBatch.from_pydict(answer(b.slice(at, 2000), periods))

    return shards.mapInArrow(run, T.StructType(kinds))


def _report(got: DataFrame, entity: str, day: str, periods: Sequence[int]) -> DataFrame:
    out = [F.col("entity").alias(entity), from_day(F.col("day")).alias(day)]
    for p in periods:
        out += [F.col(f"total_{p}"), F.when(F.col(f"count_{p}") > 0, F.col(f"total_{p}") / F.col(f"count_{p}")).alias(f"avg_{p}"), F.col(f"count_{p}")]
    return got.select(*out)


def _checked(periods: Sequence[int]) -> None:
    if not periods or not all(0 < p for p in periods):
        raise ValueError("periods must be one day or more")


def rolling_totals(df: DataFrame, entity: str, day: str, value: str, periods: Sequence[int] = (7, 30), row_key: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """One row per entity and calendar day from its first to its last day (any row): totals, averages and counts of the
    present values of the last ``periods`` days, the day itself included. ``where`` filters the result by its columns.

    Plan: duplicates and days are aggregated map-side first; one exchange by entity of the shards; no Python but one Arrow pass."""
    _checked(periods)
    got = _answers(shard_leaves(daily_totals(df, entity, day, value, row_key), periods), periods)
    return _report(got if where is None else got.where(where), entity, day, periods)


#: The stored form of a shard: its tree, and the first and last day of it that has any row.
TREE = "entity string, shard int, sums array<double>, counts array<bigint>, lo int, hi int"


def _rows(b: pa.RecordBatch, s: np.ndarray, c: np.ndarray, lo: pa.Array, hi: pa.Array) -> pa.RecordBatch:
    lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * 2 * SHARD_DAYS, pa.int32()), pa.array(x.reshape(-1), kind))
    return pa.RecordBatch.from_pydict({"entity": b["entity"], "shard": b["shard"], "sums": lists(s, pa.float64()), "counts": lists(c, pa.int64()), "lo": lo, "hi": hi})


def build_trees(daily: DataFrame) -> DataFrame:
    """The stored form: one row per entity and shard with its tree. Write it as a table to keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, c = map(build, _scatter(_whole(b["leaves"]), b["shard"].to_numpy()))
            yield _rows(b, s, c, b["lo"], b["hi"])

    shard = F.floor(F.col("day") / SHARD_DAYS).cast("int").alias("shard")
    return daily.groupBy("entity", shard).agg(F.collect_list(F.struct("day", "s", "c")).alias("leaves"), F.min("day").alias("lo"), F.max("day").alias("hi")).mapInArrow(run, TREE)


def correct(s: np.ndarray, c: np.ndarray, row: np.ndarray, leaf: np.ndarray, ds: np.ndarray, dc: np.ndarray) -> None:
    """Adds ds and dc to leaves of trees, in place, and renews the ancestors of these leaves: log2(SHARD_DAYS) + 1 nodes a correction."""
    node = leaf + s.shape[1] // 2
    np.add.at(s, (row, node), ds)
    np.add.at(c, (row, node), dc)
    while (node := node >> 1).any():
        s[row, node], c[row, node] = s[row, 2 * node] + s[row, 2 * node + 1], c[row, 2 * node] + c[row, 2 * node + 1]


def correct_trees(trees: DataFrame, changes: DataFrame) -> DataFrame:
    """Trees after late corrections. ``changes``: (entity, day, s, c), what is to be added to a day's sum and count; a day with nothing to add makes the entity's span reach it.
    Shards without corrections pass as they are and see no Python; of the others only leaves and their ancestors change."""
    shard = F.floor(F.col("day") / SHARD_DAYS).cast("int").alias("shard")
    new = changes.where("entity is not null and day is not null").groupBy("entity", "day").agg(F.sum("s").alias("s"), F.sum("c").cast("int").alias("c"))
    new = new.groupBy("entity", shard).agg(F.collect_list(F.struct("day", "s", "c")).alias("leaves"), F.min("day").alias("new_lo"), F.max("day").alias("new_hi"))
    touched = new.join(trees, ["entity", "shard"], "left").select("entity", "shard", "sums", "counts", "leaves", F.least("lo", "new_lo").alias("lo"), F.greatest("hi", "new_hi").alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, c = _stored(b["sums"], float), _stored(b["counts"], np.int64)
            lists = _whole(b["leaves"])
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            day, ds, dc = (lists.flatten().field(x).to_numpy(zero_copy_only=False) for x in ("day", "s", "c"))
            correct(s, c, row, day - b["shard"].to_numpy()[row] * SHARD_DAYS, ds, dc)
            yield _rows(b, s, c, b["lo"], b["hi"])

    return trees.join(new, ["entity", "shard"], "left_anti").select(*trees.columns).unionByName(touched.mapInArrow(run, TREE))


def rolling_from_trees(trees: DataFrame, periods: Sequence[int] = (7, 30), entity: str = "entity", day: str = "day") -> DataFrame:
    """What ``rolling_totals`` gives, answered from stored trees."""
    _checked(periods)
    shards = with_before(trees, ["sums", "counts"], {"root_s": F.get("sums", F.lit(1)), "root_c": F.get("counts", F.lit(1))}, periods)
    return _report(_answers(shards, periods), entity, day, periods)


def tree_days(trees: DataFrame) -> DataFrame:
    """(entity, day, s, c) of the stored trees' leaves that have a count, the way back."""
    i = F.posexplode(F.slice("counts", SHARD_DAYS + 1, SHARD_DAYS)).alias("i", "c")
    got = trees.select("entity", "shard", "sums", i).where("c > 0")
    return got.select("entity", (F.col("shard") * SHARD_DAYS + F.col("i")).cast("int").alias("day"), F.expr(f"element_at(sums, {SHARD_DAYS + 1} + i)").alias("s"), F.col("c").cast("int").alias("c"))
