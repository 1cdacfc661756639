"""Mixing sources to target weights by capped water-filling.

Sizes are tokens of a public tokenizer. A source may be used at most ``max_repeats`` times; what it cannot supply is redistributed to the others in
proportion to their targets until nothing changes. Each source's epochs are a whole part, that every record gets, and a fraction, that goes to the records
first in a seeded order, up to the size wanted and at most one record beyond.

Defined results: records of sources without a target, null sources and null, blank or empty texts (no tokens) are never drawn; a source without records
gets nothing, and its weight is redistributed; shares are of the drawn total. Whole-row duplicates count once by their id.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import bounded_rows, col, cut, require

#: Folder of public vocabularies; a parameter everywhere, nothing of it is kept here.
TOKENIZERS = "/opt/tokenizers"
MAX_SOURCES = 10_000
#: Parts that a source is cut into by the seeded hash, and that its one part at the border is cut into, and so on: after three cuts 10^11 records leave six.
PARTS = (1024, 4096, 4096)


@functools.lru_cache(4)
def tokenizer(path: str):
    """The byte-level encoder of a .tiktoken file of ranks, as counts of tokens of texts."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    # the word pattern published with this vocabulary, a fixed value
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, name: str = "n_tokens", path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """``df`` with the number of tokens of a text; null and blank texts have 0. The vocabulary goes to the executors with the job and is read once a worker."""
    df.sparkSession.sparkContext.addFile(path)
    name_there = os.path.basename(path)

    @F.pandas_udf("long")
    def count(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = tokenizer(SparkFiles.get(name_there))
        for s in it:
            yield s.map(lambda t: len(enc.encode_ordinary(t)) if t is not None and t.strip() else 0).astype("int64")

    return df.withColumn(name, count(col(text)))


@dataclass(frozen=True)
class Plan:
    source: str
    target: float
    cap: int
    available: int
    wanted: float

    @property
    def epochs(self) -> float:
        return min(self.wanted / self.available, float(self.cap)) if self.available else 0.0


def water_fill(sources: Sequence[tuple[str, float, int, int]], total: float | None = None) -> list[Plan]:
    """``sources``: (name, target share, most repeats, tokens at hand). Without a total the largest one is taken at which every source that has
    records meets its target exactly."""
    live = [s for s in sources if s[3] > 0 and s[2] > 0 and s[1] > 0]
    weight = sum(s[1] for s in live)
    if total is None:
        total = min((s[2] * s[3] / (s[1] / weight) for s in live), default=0.0)
    total = min(total, float(sum(s[2] * s[3] for s in live)))
    got: dict[str, float] = {}
    left, free = total, list(live)
    while free:
        w = sum(s[1] for s in free)
        full = [s for s in free if s[2] * s[3] < left * s[1] / w * (1 - 1e-12)]
        if not full:
            got |= {s[0]: left * s[1] / w for s in free}
            break
        got |= {s[0]: float(s[2] * s[3]) for s in full}
        left -= sum(s[2] * s[3] for s in full)
        free = [s for s in free if s not in full]
    return [Plan(n, t, c, a, got.get(n, 0.0)) for n, t, c, a in sources]


def mix(docs: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", total: float | None = None, seed: int = 17, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", of_hand: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(drawn, report). drawn: key, source, n_tokens, repeats (> 0). report: a row per target source with the shares reached. ``of_hand`` gives the total as a multiple
    of the tokens that the target sources hold.

    Records are tokenized once, in place; only (key, source, size) is written and read again. The order within a source is that of a seeded hash, cut by tables of sizes by
    (source, part of the hash): the one part at the border is cut again, and only what PARTS leave of it, a few records, is ordered by record."""
    require(docs, key, source, text)
    require(targets, "source", "target_share", "max_repeats")
    want = bounded_rows(targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("t"), F.max("max_repeats").alias("m")), MAX_SOURCES, "target sources")
    want = [(r["source"], float(r["t"] or 0), int(r["m"] or 0)) for r in want]
    h = F.xxhash64(F.lit(seed), F.col("key"))
    sized = token_counts(docs.where(col(source).isin([w[0] for w in want])).select(col(key).alias("key"), col(source).alias("src"), col(text).alias("text")), "text", path=path).drop("text").distinct()
    sized = cut(sized.select("key", "src", "n_tokens", h.alias("h")).where("n_tokens > 0"))
    sizes = {r["src"]: r["n"] for r in bounded_rows(sized.groupBy("src").agg(F.sum("n_tokens").alias("n")), MAX_SOURCES, "sources")}
    if of_hand is not None:
        if total is not None:
            raise ValueError("total and of_hand exclude each other")
        total = of_hand * sum(sizes.values())
    plans = [p for p in water_fill([(s, t, m, sizes.get(s, 0)) for s, t, m in want], total)]
    spark = docs.sparkSession
    table = spark.createDataFrame([(p.source, p.target, p.cap, p.available, p.wanted, int(p.epochs), (p.epochs - int(p.epochs)) * p.available) for p in plans], "src string, target_share double, max_repeats int, available bigint, wanted double, whole int, part double")
    # ``room``: tokens of the source's fraction that the parts before this one leave
    edge = sized.join(F.broadcast(table.select("src", "whole", F.col("part").alias("room"))), "src")
    drawn = None
    for level, parts in enumerate(PARTS):
        part = F.pmod(F.shiftrightunsigned("h", sum(p.bit_length() - 1 for p in PARTS[:level])), F.lit(parts)).cast("int")
        edge = edge.withColumn("bucket", part)
        sums = edge.groupBy("src", "bucket").agg(F.sum("n_tokens").alias("n"), F.first("room").alias("room"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most ``parts`` rows a source
        sums = sums.select("src", "bucket", "n", "room", before.alias("before"))
        sums = sums.select("src", "bucket", F.when(F.col("before") + F.col("n") <= F.col("room") + 1e-6, 1).when(F.col("before") >= F.col("room"), 0).alias("extra"), (F.col("room") - F.col("before")).alias("left"))
        rows = edge.drop("room").join(sums, ["src", "bucket"])
        sure = rows.where("extra is not null").select("key", "src", "n_tokens", "whole", "extra")
        drawn = sure if drawn is None else drawn.unionByName(sure)
        # one part of 1,024 or fewer of a source, by sizes that add up: written, so that no level reads more than its own
        edge = cut(rows.where("extra is null").select("key", "src", "n_tokens", "h", "whole", F.col("left").alias("room")))
    inner = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("src").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = edge.withColumn("extra", (inner + F.col("n_tokens") / 2 <= F.col("room")).cast("int")).select("key", "src", "n_tokens", "whole", "extra")
    drawn = drawn.unionByName(edge).select(F.col("key").alias(key), F.col("src").alias(source), "n_tokens", (F.col("whole") + F.col("extra")).alias("repeats")).where("repeats > 0")
    used = drawn.groupBy(F.col(source).alias("src")).agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn_tokens"), F.max("repeats").alias("most_repeats"), F.count("*").alias("records"))
    report = table.join(used, "src", "left").na.fill(0, ["drawn_tokens", "most_repeats", "records"])
    every = F.sum("drawn_tokens").over(Window.partitionBy())  # a row a source
    report = report.select(F.col("src").alias("source"), "target_share", "max_repeats", F.col("available").alias("available_tokens"), "drawn_tokens", F.when(every > 0, F.col("drawn_tokens") / every).alias("actual_share"), "most_repeats", "records")
    return drawn, report
