"""Code search: structural chunks, overlapping parts, vectors, cosine ranking and the context for a chat."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require

QUERY_BLOCK = 20_000
#: A line that opens a chunk, and its name: the second word up to a bracket or colon.
OPENS, NAMED = r"^\s*(def|class) ", r"^\s*\S+\s+([^\s(:]*)"


def structural_chunks(files: DataFrame, path: str = "file_path", text: str = "text", opens: str = OPENS, named: str = NAMED) -> DataFrame:
    """(id, file_path, object_name, start_line, end_line, text). A chunk runs from a line that opens one to the next; lines before the first are left out; a text without
    any is one chunk; a blank text none. Within a text's own row: lines become an array, nothing is shuffled and no line loses its place."""
    require(files, path, text)
    rows = files.where(F.length(F.trim(F.regexp_replace(col(text), r"\s", ""))) > 0).select(col(path).alias("file_path"), F.split(col(text), "\n").alias("_l"))
    starts = F.filter(F.transform("_l", lambda x, i: F.when(x.rlike(opens), i + 1)), lambda i: i.isNotNull())
    rows = rows.withColumn("_s", starts)
    whole = F.size("_s") == 0
    rows = rows.withColumns({"_s": F.when(whole, F.array(F.lit(1))).otherwise(F.col("_s")), "_w": whole})
    rows = rows.select("*", F.posexplode("_s").alias("_k", "start_line"))
    rows = rows.withColumn("end_line", F.coalesce(F.get("_s", F.col("_k") + 1) - 1, F.size("_l")))
    body = F.array_join(F.slice("_l", F.col("start_line"), F.col("end_line") - F.col("start_line") + 1), "\n")
    name = F.when(~F.col("_w"), F.regexp_extract(F.get("_l", F.col("start_line") - 1), named, 1))
    return rows.select(F.format_string("%s:%d-%d", "file_path", "start_line", "end_line").alias("id"), "file_path", name.alias("object_name"), "start_line", "end_line", body.alias("text"))


def overlapping_parts(chunks: DataFrame, key: str = "id", text: str = "text", size: int = 2000, overlap: int = 200) -> DataFrame:
    """Texts of at most ``size`` as they are, others as windows that begin every size - overlap characters, the last perhaps within the one before; keys get #part1, 2, …"""
    require(chunks, key, text)
    step = size - overlap
    at = F.when(F.length(col(text)) > size, F.sequence(F.lit(0), F.length(col(text)) - 1, F.lit(step))).otherwise(F.array(F.lit(-1)))
    out = chunks.select("*", F.explode(at).alias("_at"))
    cut = F.col("_at") >= 0
    return out.withColumns({key: F.when(cut, F.concat(col(key), F.lit("#part"), (F.col("_at") / step).cast("int") + 1)).otherwise(col(key)), text: F.when(cut, F.substring(col(text), F.col("_at") + 1, F.lit(size))).otherwise(col(text))}).drop("_at")


def not_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(col(text).rlike(r"\S"))


def hashed_vector(text: str, dims: int = 64) -> list[float]:
    """Feature hashing of words: signed counts, length 1; the offline stand-in for a service."""
    import zlib

    v = np.zeros(dims)
    for w in text.lower().split():
        h = zlib.crc32(w.encode())
        v[h % dims] += 1 if h >> 31 else -1
    n = np.linalg.norm(v)
    return (v / n if n else v).astype(np.float32).tolist()


def embed(df: DataFrame, text: str = "text", name: str = "embedding", embedder: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """Vectors by any batch embedder that can be sent to executors; a null text has none."""
    require(df, text)

    @F.pandas_udf("array<float>")
    def run(s: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in s:
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            there = batch.dropna()
            got = embedder(there.tolist()) if embedder else [hashed_vector(t) for t in there]
            for i, v in zip(there.index, got):
                out[i] = v
            yield out

    return df.withColumn(name, run(col(text)))


def build_index(files: DataFrame, size: int = 2000, overlap: int = 200, embedder: Callable | None = None) -> DataFrame:
    return embed(not_blank(overlapping_parts(structural_chunks(files), size=size, overlap=overlap)), embedder=embedder)


def checked_index(files: DataFrame, text: str = "text", **how) -> DataFrame:
    """``build_index`` with its errors: ValueError where texts are no texts, there is no file, or no file gives a chunk. Needs two small actions."""
    require(files, text)
    if files.schema[text].dataType.typeName() not in ("string", "varchar", "char"):
        raise ValueError(f"{text} must hold texts, is {files.schema[text].dataType.simpleString()}")
    if files.isEmpty():
        raise ValueError("no files to index")
    got = build_index(files, **how)
    if got.drop("embedding").isEmpty():
        raise ValueError("all files are blank: nothing to index")
    return got


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-8)


def search(index: DataFrame, question: list[float], key: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """The k best rows for one query; each task keeps k."""
    q = F.array(*[F.lit(float(x)).cast("float") for x in question])
    return index.withColumn("score", cosine(col(vector), q)).orderBy(F.desc("score"), col(key)).limit(k)


def search_many(index: DataFrame, questions: DataFrame, key: str = "vec_id", vector: str = "embedding", query_key: str = "query_id", query_vector: str = "query", k: int = 8) -> DataFrame:
    """(query_key, key, score, rank): the k best rows for each row of a stated set of queries, against all rows. Queries are sent in blocks of at most about QUERY_BLOCK; each Arrow batch is
    one matrix product for each length of query and gives k rows a query, so what is shuffled is short. A query meets the vectors of its own length; nulls score nothing."""
    require(index, key, vector)
    require(questions, query_key, query_vector)
    sc, blocks = index.sparkSession.sparkContext, max(1, -(-questions.count() // QUERY_BLOCK))
    schema = f"query {questions.schema[query_key].dataType.simpleString()}, item {index.schema[key].dataType.simpleString()}, score double"
    parts = []
    for block in range(blocks):
        rows = questions.where(col(query_vector).isNotNull() & (F.pmod(F.xxhash64(col(query_key)), F.lit(blocks)) == block)).select(col(query_key).alias("q"), col(query_vector).alias("v")).collect()
        sizes: dict[int, list] = {}
        for r in rows:
            sizes.setdefault(len(r["v"]), []).append(r)
        shared = sc.broadcast([([r["q"] for r in rs], np.array([r["v"] for r in rs], float).reshape(len(rs), size)) for size, rs in sizes.items()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = [(pa.array(names), q, np.linalg.norm(q, axis=1)) for names, q in shared.value]
            for whole in batches:
                for names, q, q_norm in asked:
                    b = whole.filter(pc.fill_null(pc.equal(pc.list_value_length(whole["v"]), q.shape[1]), False))
                    if not b.num_rows:
                        continue
                    x = b["v"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, q.shape[1])
                    x_norm = np.linalg.norm(x, axis=1)
                    order = pc.rank(b["k"], tiebreaker="first").to_numpy()
                    for at in range(0, len(q), 256):
                        score = q[at : at + 256] @ x.T / (q_norm[at : at + 256, None] * x_norm + 1e-8)
                        # ties go to the smaller key, so that no batch drops one that the whole would keep
                        top = np.lexsort((np.broadcast_to(order, score.shape), -np.nan_to_num(score, nan=-np.inf)), axis=1)[:, :k]
                        r = np.repeat(np.arange(len(score)), top.shape[1])
                        c = top.reshape(-1)
                        yield pa.RecordBatch.from_pydict({"query": names.take(pa.array(r + at)), "item": b["k"].take(pa.array(c)), "score": pa.array(score[r, c])})

        parts.append(index.where(col(vector).isNotNull()).select(col(key).alias("k"), col(vector).alias("v")).mapInArrow(run, schema))
    pairs = parts[0]
    for p in parts[1:]:
        pairs = pairs.unionByName(p)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return pairs.select(F.col("query").alias(query_key), F.col("item").alias(key), "score", "rank")


def retrieval_queries(turns: DataFrame, conversation: str, turn: str, text: str, history: int = 6) -> DataFrame:
    """(conversation, turn, query): a question by itself, or after the last ``history`` questions of its conversation."""
    w = Window.partitionBy(col(conversation)).orderBy(col(turn)).rowsBetween(-history, -1)
    before = F.collect_list(col(text)).over(w)
    query = F.when(F.size(before) > 0, F.concat(F.array_join(before, "\n\n"), F.lit("\n\nFollow-up question: "), col(text))).otherwise(col(text))
    return turns.select(col(conversation), col(turn), query.alias("query"))


def last_turns(turns: DataFrame, conversation: str, turn: str, n: int) -> DataFrame:
    w = Window.partitionBy(col(conversation)).orderBy(col(turn).desc())
    return turns.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def context_block(ranked: DataFrame, rank: str = "rank", group: str | None = None) -> DataFrame:
    """One text of the ranked chunks, in order: a heading, the text, a dashed rule."""
    head = F.format_string("[%d] %s :: %s (lines %d-%d)\n%s\n%s", col(rank), col("file_path"), F.coalesce(col("object_name"), F.lit("-")), col("start_line"), col("end_line"), col("text"), F.lit("-" * 40))
    blocks = F.transform(F.array_sort(F.collect_list(F.struct(col(rank).alias("r"), head.alias("t")))), lambda x: x["t"])
    out = F.array_join(blocks, "\n").alias("context")
    return ranked.groupBy(col(group)).agg(out) if group else ranked.agg(out)


def chat_messages(system: str, turns: list[tuple[str, str]], context: str, question: str, keep: int = 6) -> list[dict[str, str]]:
    """The messages of a chat call, which is the caller's."""
    out = [{"role": "system", "content": system}]
    for q, a in turns[-keep:] if keep else []:
        out += [{"role": "user", "content": q}, {"role": "assistant", "content": a}]
    return [*out, {"role": "user", "content": f"{context}\n\n{question}"}]
