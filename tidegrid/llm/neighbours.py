"""The k most similar vectors of every vector, by a forest of random-projection trees.

Trees are fitted on a bounded sample; every vector is indexed in one leaf of each tree and asks ``visits`` leaves, chosen by one priority queue over all trees. Leaves meet their
visitors in one shuffle, as single bytes (``compact``) or floats; each leaf ranks its members for each visitor, tile by tile, so that no task holds more than a tile of
members and a block of visitors, and the best of all leaves are merged. Compact
candidates are then reranked with the exact vectors.

Defined results: a vector is usable if it has ``dims`` finite values, not all zero; others, and null ids, neither ask nor answer; rows that repeat count once (an id has one vector); ties go to the smaller id;
of copies of one vector beyond ``k + 1`` only the first by id are indexed, and the rest get the first k of their class: that is exact, and no class of copies can fill a leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import col, cut, require
from tidegrid.llm.forest import Forest, fit

#: Vectors that shape the trees: so many at least, so many for each leaf, and so many at most; all are indexed.
SAMPLE, LEAF_SAMPLE, MOST_SAMPLE = 32_768, 16, 262_144
#: Members of a leaf that one task ranks, and visitors that it ranks them for; larger leaves are tiled. Classes of copies that are broadcast at most, beyond that they are joined by shuffle.
TILE, VISITORS, BIG_CLASSES = 16_384, 65_536, 100_000
#: What a cosine of single bytes may be off.
SLACK = 0.01


def usable(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(id, v): v the bytes of ``dims`` floats, of length 1. Arrow arrays are normalised as whole batches; expressions over elements would cost the JVM ten times as much."""
    require(df, key, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pc.and_(pc.is_valid(b["id"]), pc.fill_null(pc.equal(pc.list_value_length(b["w"]), dims), False)))
            x = b["w"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # a null element becomes NaN
            with np.errstate(all="ignore"):
                n = np.linalg.norm(x, axis=1)
                good = (n > 0) & np.isfinite(n)
                v = (x[good] / n[good, None]).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"id": b["id"].filter(pa.array(good)), "v": packed(v)})

    return df.select(col(key).cast("string").alias("id"), col(vector).alias("w")).mapInArrow(run, "id string, v binary")


def packed(v: np.ndarray) -> pa.Array:
    """Rows as binary values, without a Python object for each."""
    v = np.ascontiguousarray(v)
    size = v.shape[1] * v.itemsize
    offsets = np.arange(len(v) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(offsets), pa.py_buffer(v.tobytes())])


def unpacked(a: pa.Array | pa.ChunkedArray, kind: type, dims: int) -> np.ndarray:
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks() if a.num_chunks != 1 else a.chunk(0)
    if not len(a):
        return np.zeros((0, dims), kind)
    at = np.frombuffer(a.buffers()[1], np.int64 if a.type == pa.large_binary() else np.int32)[a.offset : a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(-1, dims)


def largest(x: np.ndarray, k: int, width: int = 64) -> np.ndarray:
    """Columns of the k largest values of each row. They lie in the k stretches of ``width`` columns with the largest maxima, so only these are partitioned."""
    n, m = x.shape
    if m <= 4 * k * width:
        return np.argpartition(-x, min(k, m) - 1, axis=1)[:, :k] if m else np.zeros((n, 0), np.int64)
    whole = m // width
    peak = x[:, : whole * width].reshape(n, whole, width).max(axis=2)
    few = np.argpartition(-peak, k - 1, axis=1)[:, :k]
    at = (few[:, :, None] * width + np.arange(width)).reshape(n, -1)
    at = np.concatenate([at, np.broadcast_to(np.arange(whole * width, m), (n, m - whole * width))], axis=1)
    pick = np.argpartition(-np.take_along_axis(x, at, axis=1), k - 1, axis=1)[:, :k]
    return np.take_along_axis(at, pick, axis=1)


def search(vectors: DataFrame, k: int, trees: int, visits: int, leaf_size: int, min_cosine: float | None, compact: bool, dims: int, max_depth: int | None = None, seed: int = 5) -> DataFrame:
    """(id_a, id_b, cosine): of each vector the best ``k`` members of the leaves it visits. ``vectors``: (id, v) of length 1, bounded copies; read three times (count, sample, routing), each a scan."""
    n = vectors.count()
    depth = max(1, math.ceil(math.log2(max(n, 2) / leaf_size)))
    depth = depth if max_depth is None else min(depth, max_depth)
    size = min(max(SAMPLE, LEAF_SAMPLE << depth), MOST_SAMPLE)
    share = min(1.0, size / max(n, 1))
    sample = sorted((r["id"], bytes(r["v"])) for r in vectors.where(F.abs(F.xxhash64("id") % 1_000_003) < math.ceil(share * 1_000_003)).limit(2 * size).collect())
    x = np.frombuffer(b"".join(v for _, v in sample), np.float32).reshape(len(sample), dims)
    forest = fit(x, trees, depth, seed)
    # tiles of members and blocks of visitors that each leaf is cut into, by its share of the sample
    members, askers = np.zeros(trees << depth), np.zeros(trees << depth)
    for at in range(0, len(x), 4096):
        leaf, own = forest.visits(x[at : at + 4096], max(visits, trees))
        np.add.at(members, leaf[:, own], 1)
        np.add.at(askers, leaf, 1)
    scale = n / max(len(x), 1)
    tiles, blocks = (np.maximum(np.ceil(c * scale / most), 1).astype(np.int64) for c, most in ((members, TILE), (askers, VISITORS)))
    shared = vectors.sparkSession.sparkContext.broadcast((forest.directions, forest.cuts, tiles, blocks))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, (tiles, blocks) = Forest(*shared.value[:2]), shared.value[2:]
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                v = unpacked(b["v"], np.float32, dims)
                leaf, own = forest.visits(v, max(visits, trees))
                if compact:
                    scale = np.abs(v).max(axis=1, keepdims=True) / 127
                    body = np.rint(v / scale).astype(np.int8)
                else:
                    body = v
                once = np.ones(leaf.shape, bool)
                for j in range(1, leaf.shape[1]):
                    once[:, j] = (leaf[:, :j] != leaf[:, j : j + 1]).all(axis=1)
                # as a visitor to each tile of a leaf, in its own block; as a member to each block, in its own tile; both in one row where they meet
                place, own, at_row = leaf[once], np.broadcast_to(own, leaf.shape)[once], np.repeat(np.arange(len(v)), leaf.shape[1])[once.reshape(-1)]
                h = b["h"].to_numpy().astype(np.uint64)[at_row]
                tile, block = (h % tiles[place].astype(np.uint64)).astype(np.int64), ((h >> np.uint64(32)) % blocks[place].astype(np.uint64)).astype(np.int64)
                kinds = [(np.flatnonzero(tiles[place] > t), "visitor", t) for t in range(int(tiles[place].max(initial=0)))] + [(np.flatnonzero(own & (blocks[place] > k) & (block != k)), "member", k) for k in range(int(blocks[place].max(initial=0)))]
                for use, kind, k in kinds:
                    if len(use):
                        asks = kind == "visitor"
                        yield pa.RecordBatch.from_pydict({
                            "leaf": pa.array(place[use]), "tile": pa.array(np.full(len(use), k) if asks else tile[use]), "block": pa.array(block[use] if asks else np.full(len(use), k)), "id": b["id"].take(pa.array(at_row[use])),
                            "own": pa.array(own[use] & (tile[use] == k) if asks else np.ones(len(use), bool)), "asks": pa.array(np.full(len(use), asks)), "body": packed(body).take(pa.array(at_row[use])),
                        })

    def rank(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        _, first = np.unique(pc.dictionary_encode(pc.cast(table["id"], pa.string())).combine_chunks().indices.to_numpy(), return_index=True)
        if len(first) < table.num_rows:  # rows that repeat
            table = table.take(pa.array(np.sort(first))).combine_chunks()
        v = unpacked(table["body"], np.int8 if compact else np.float32, dims).astype(np.float32)
        if compact:
            v /= np.linalg.norm(v, axis=1, keepdims=True)
        ids = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
        member = np.flatnonzero(table["own"].to_numpy(zero_copy_only=False))
        m = np.ascontiguousarray(v[member].T)
        bar = -2.0 if min_cosine is None else min_cosine - (SLACK if compact else 1e-6)
        keep = k + (k if compact else 0)
        a, b, s = [], [], []
        step = max(64, 8_000_000 // max(len(member), 1))
        place = np.full(len(v), -1)
        place[member] = np.arange(len(member))
        asks = np.flatnonzero(table["asks"].to_numpy(zero_copy_only=False))
        for at in range(0, len(asks) if len(member) else 0, step):
            who = asks[at : at + step]
            got = v[who] @ m
            rows = np.arange(len(got))
            mine = place[who]
            got[rows[mine >= 0], mine[mine >= 0]] = -3
            if min_cosine is not None:
                r, c = np.nonzero(got >= bar)
            else:
                top = largest(got, keep)
                r, c = np.repeat(rows, top.shape[1]), top.reshape(-1)
                ok = got[r, c] > -2.5
                r, c = r[ok], c[ok]
            a.append(who[r])
            b.append(member[c])
            s.append(got[r, c])
        a, b, s = (np.concatenate(z) if z else np.zeros(0, int) for z in (a, b, s))
        if min_cosine is not None and len(a):  # the best of each visitor
            order = np.lexsort((-s, a))
            a, b, s = a[order], b[order], s[order]
            first = np.r_[0, np.flatnonzero(a[1:] != a[:-1]) + 1]
            nth = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
            a, b, s = a[nth < keep], b[nth < keep], s[nth < keep]
        return pa.table({"id_a": ids.take(pa.array(a.astype(np.int64))), "id_b": ids.take(pa.array(b.astype(np.int64))), "cosine": pa.array(s.astype(np.float64))})

    routed = vectors.select("id", "v", F.xxhash64("id", F.lit(seed)).alias("h")).mapInArrow(route, "leaf bigint, tile bigint, block bigint, id string, own boolean, asks boolean, body binary")
    return routed.groupBy("leaf", "tile", "block").applyInArrow(rank, "id_a string, id_b string, cosine double")


def best(pairs: DataFrame, k: int) -> DataFrame:
    """The k best distinct partners of each id_a; at most ``visits`` short lists an id meet here."""
    one = pairs.groupBy("id_a", "id_b").agg(F.max("cosine").alias("cosine"))
    lists = one.groupBy("id_a").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("d"), "id_b"))), 1, k).alias("x"))
    return lists.select("id_a", F.explode("x").alias("x")).select("id_a", "x.id_b", (-F.col("x.d")).alias("cosine"))


def nearest(df: DataFrame, key: str, vector: str, k: int = 10, min_cosine: float | None = None, trees: int = 3, visits: int = 6, leaf_size: int = 2048, compact: bool = True, dims: int = 64, max_depth: int | None = None) -> DataFrame:
    """(id_a, id_b, cosine): for every usable vector its k most similar others, those of at least ``min_cosine`` if given. Trees are as deep as ``leaf_size`` asks,
    ``max_depth`` at most: with it, ``visits`` leaves hold a fixed share of all vectors at least, whatever their number."""
    vectors = usable(df, key, vector, dims)
    h = F.xxhash64("v")
    classes = cut(vectors.groupBy(h.alias("h")).agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("h"))
    big = classes.limit(BIG_CLASSES + 1).count()
    heads = vectors
    tails = None
    if big:
        few = F.broadcast(classes) if big <= BIG_CLASSES else classes
        hot = vectors.select("id", "v", h.alias("h")).join(few, "h")
        nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
        head = cut(hot.groupBy("h", "v", "id").agg(F.lit(1).alias("_")).select("id", "v", nth.alias("nth")).where(F.col("nth") <= k + 1))  # pruned before the shuffle by the rank's limit
        heads = vectors.select("id", "v", h.alias("h")).join(few, "h", "left_anti").select("id", "v").unionByName(head.select("id", "v"))
        first = head.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        tails = hot.select("id", "v").distinct().join(first, "v").where(~F.array_contains("ids", F.col("id"))).select(F.col("id").alias("id_a"), F.explode(F.slice("ids", 1, k)).alias("id_b"), F.lit(1.0).alias("cosine"))
    got = search(heads, k, trees, visits, leaf_size, min_cosine, compact, dims, max_depth)
    if compact:
        pairs = got.groupBy("id_a", "id_b").agg(F.max("cosine").alias("c"))
        pairs = cut(pairs)
        both = pairs.join(vectors.select(F.col("id").alias("id_a"), F.col("v").alias("va")), "id_a").join(vectors.select(F.col("id").alias("id_b"), F.col("v").alias("vb")), "id_b")

        def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                a, b = (unpacked(x[c], np.float32, dims).astype(np.float64) for c in ("va", "vb"))
                c = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
                yield pa.RecordBatch.from_pydict({"id_a": x["id_a"], "id_b": x["id_b"], "cosine": pa.array(c)})

        got = both.select("id_a", "id_b", "va", "vb").mapInArrow(rerank, "id_a string, id_b string, cosine double")
    if min_cosine is not None:
        got = got.where(F.col("cosine") >= min_cosine - 1e-9)
    got = best(got, k)
    return got.unionByName(tails) if tails is not None else got
