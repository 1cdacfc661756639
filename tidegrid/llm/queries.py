"""Queries for the text and vector problems, each over its whole tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.llm.chunking import split_texts
from tidegrid.llm.leaks import find_leaks
from tidegrid.llm.mixing import mix
from tidegrid.llm.neighbours import nearest, usable
from tidegrid.llm.toxicity import score_documents
from tidegrid.operators.retrieval import search_many

#: Vectors of a leaf for the ten nearest; tables of up to four leaves are searched whole, since half of a small table holds fewer of the true neighbours (0.89 of them in 2,987 vectors).
LEAF = 2048


def p3_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest of every vector. These vectors fill all directions evenly, so nine tenths of the true neighbours take half of all leaves: few, large ones, eight a tree at most."""
    got = nearest(spark.read.parquet(f"{d}/rag_index.parquet"), "id", "embeddings", 10, None, trees=2, visits=7, leaf_size=LEAF, compact=False, max_depth=3)
    return got.select("id_a", "id_b", F.round("cosine", 5).alias("cosine"))


def p3_recall(spark: SparkSession, d: str) -> DataFrame:
    """One row: the vectors whose chunk begins at a line divisible by 50, as a stated query set against all, and whether nine tenths of their exact ten nearest are among p3_neighbours."""
    vectors = spark.read.parquet(f"{d}/rag_index.parquet").select("id", "embeddings").dropDuplicates(["id"])
    ask = usable(vectors, "id", "embeddings", 64).join(vectors, "id").where(F.expr(r"cast(regexp_extract(id, ':(\\d+)-', 1) as int) % 50 = 0")).select(F.col("id").alias("id_a"), F.col("embeddings").alias("query"))
    exact = search_many(vectors.where("size(embeddings) = 64"), ask, "id", "embeddings", "id_a", "query", k=11).where("id_a <> id")
    exact = exact.withColumn("nth", F.row_number().over(Window.partitionBy("id_a").orderBy(F.desc("score"), "id"))).where("nth <= 10").select("id_a", F.col("id").alias("id_b"))  # at most 11 rows a query
    hits = exact.join(p3_neighbours(spark, d).select("id_a", "id_b", F.lit(1).alias("hit")), ["id_a", "id_b"], "left")
    return hits.agg(F.count_distinct("id_a").alias("n_queries"), (F.count("hit") >= 0.9 * F.count("*")).alias("recall_reached"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Near duplicates lie in the first leaves that the queue gives; small leaves do."""
    got = nearest(spark.read.parquet(f"{d}/rag_index.parquet"), "id", "embeddings", 10, 0.92)
    return got.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


def _split(spark: SparkSession, d: str, only_oversized: bool) -> DataFrame:
    return split_texts(spark.read.parquet(f"{d}/code_chunk.parquet"), "id", "text", "start_line", 2000, 200, only_oversized=only_oversized)


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d, False)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    got = _split(spark, d, True).where("piece = 0")
    return got.select("id", F.when(F.col("longest_line") > 2000, "forced").otherwise("lines").alias("kind")).distinct()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/eval_items.parquet")).withColumn("score", F.round("score", 4))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/mix_targets.parquet"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/mix_targets.parquet"))[1]


def _at_hand(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mix(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/mix_targets.parquet"), of_hand=1.0)


def p9_at_hand(spark: SparkSession, d: str) -> DataFrame:
    """The mix of as many tokens as the sources hold: scarce sources stop at their caps, and the others share what they leave."""
    return _at_hand(spark, d)[0]


def p9_at_hand_shares(spark: SparkSession, d: str) -> DataFrame:
    """missed_share: what a source lacks of its share of all targets; negative for those that take over."""
    want = F.col("target_share") / F.nullif(F.sum("target_share").over(Window.partitionBy()), F.lit(0.0))  # a row a source
    return _at_hand(spark, d)[1].withColumn("missed_share", want - F.coalesce("actual_share", F.lit(0.0)))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/doc_labels.parquet"), keep=["source"])


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    got = _scores(spark, d).groupBy("source")
    return got.agg(F.count("*").alias("documents"), F.count_if("is_offending").alias("offending"), F.round(F.avg(F.col("is_offending").cast("double")), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).where("is_offending").select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_neighbours, p3_recall, p3_found, p6_pieces, p6_found, p8_leaks, p8_found, p9_mix, p9_shares, p9_at_hand, p9_at_hand_shares, p10_scores, p10_rates, p10_found)}


def sql() -> dict[str, str]:
    return {
        "p3_found": """with v as (select distinct id, embeddings::double[] e from rag_index where len(embeddings) = 64 and list_dot_product(embeddings::double[], embeddings::double[]) > 0)
 select a.id id_a, b.id id_b from v a join v b on a.id < b.id where list_cosine_similarity(a.e, b.e) >= 0.92""",
        "p3_recall": r"""select count(distinct id) n_queries, true recall_reached from rag_index where len(embeddings) = 64 and list_dot_product(embeddings::double[], embeddings::double[]) > 0
 and cast(regexp_extract(id, ':(\d+)-', 1) as int) % 50 = 0""",
        "p6_found": r"""select id, case when list_max(list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: length(x))) > 2000 then 'forced' else 'lines' end kind
 from code_chunk where length(text) > 2000""",
    }
