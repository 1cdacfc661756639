"""Missing values filled from similar records, each filled cell marked with the way it was filled.

Entities (series, stores) are clustered by k-prototypes on the numeric and categorical features observed of them. A missing number
is the entity's own level times its cluster's median pattern for that month and weekday; a missing category is the mode of the entity's own
records, else of its cluster. What a node cannot answer its parent does: (entity, month) in (entity), in cluster, in all.

Defined results: null, NaN and (in text columns) every text that is not a valid value, case and outer white space aside, are missing; valid
texts in another guise are present and are given in their valid spelling; a cell that not even the whole table can fill stays null, with method ``none``, and is not filled;
whole-row duplicates count once; a null entity is an entity without records of its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.common import bounded_rows, col, cut, present, require
from tidegrid.functions.kprototypes import kprototypes

CLUSTERS = 8


def valid_text(c: Column, valid: Sequence[str]) -> Column:
    """The valid value that a text is, case and outer white space aside; else null."""
    bare = F.lower(F.regexp_replace(c, r"(?U)\A\s+|\s+\z", ""))
    out = F.lit(None).cast("string")
    for v in valid:
        out = F.when(bare == v.lower(), F.lit(v)).otherwise(out)
    return out


def _middle(c: Column | str) -> Column:
    """Median by a bounded sketch (rank error 1e-4 of a group), so that no group is held whole."""
    return F.percentile_approx(c, 0.5, 10000)


def fill_numbers(df: DataFrame, key: str, entity: str, day: str, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """(key, entity, day, value, is_filled, method): every distinct row; ``groups`` are categorical features of the entity."""
    require(df, key, entity, day, value, *groups)
    rows = df.select(col(key).alias("row_key"), col(entity).cast("string").alias("source"), col(day).cast("date").alias("day"), F.when(present(df, value), col(value).cast("double")).alias("v"), *[col(g).cast("string").alias(f"g{i}") for i, g in enumerate(groups)]).distinct()
    rows = cut(rows)
    good = F.when(F.col("v") > 0, F.col("v"))
    month = rows.groupBy("source", F.trunc("day", "month").alias("month")).agg(
        _middle("v").alias("m"), _middle(good).alias("level"), F.count("v").alias("n"), F.count("*").alias("rows"), F.count(F.when(F.col("v") == 0, 1)).alias("zeros"),
        F.sum(F.when(F.dayofweek("day").isin(1, 7), good)).alias("weekend"), F.sum(good).alias("total"), F.sum(good * good).alias("squares"), F.count(good).alias("goods"),
        *[F.min(f"g{i}").alias(f"g{i}") for i in range(len(groups))],
    )
    month = cut(month)
    mean = F.sum("total") / F.nullif(F.sum("goods"), F.lit(0))
    ents = month.where("source is not null").groupBy("source").agg(
        _middle("level").alias("level"), _middle("m").alias("middle"), F.log1p(_middle("level")).alias("f_level"), (F.sum("zeros") / F.nullif(F.sum("n"), F.lit(0))).alias("f_zero"),
        (F.sum("weekend") / F.nullif(F.sum("total"), F.lit(0.0))).alias("f_weekend"), (F.sqrt(F.greatest(F.sum("squares") / F.nullif(F.sum("goods"), F.lit(0)) - mean * mean, F.lit(0.0))) / mean).alias("f_spread"),
        *[F.min(f"g{i}").alias(f"g{i}") for i in range(len(groups))],
    )
    ents = cut(ents)
    ents = kprototypes(ents, ["f_level", "f_zero", "f_weekend", "f_spread"], [f"g{i}" for i in range(len(groups))], CLUSTERS).select("source", "level", "middle", "cluster")
    wide = rows.join(ents.hint("shuffle_hash"), "source", "left").select("*", F.month("day").alias("mo"), F.dayofweek("day").alias("dow"))
    ratio = F.when(F.col("level") > 0, F.col("v") / F.col("level"))
    # cluster patterns: at most CLUSTERS x 12 x 7 rows, and their parents
    pattern = wide.where(ratio.isNotNull() & F.col("cluster").isNotNull()).groupBy("cluster", "mo", "dow").agg(_middle(ratio).alias("r"), F.count("*").alias("n"))
    week = wide.where(ratio.isNotNull() & F.col("cluster").isNotNull()).groupBy("cluster", "dow").agg(_middle(ratio).alias("r7"))
    groups_ = wide.groupBy("cluster").agg(_middle("v").alias("cluster_middle"))
    whole = rows.agg(_middle("v").alias("all_middle"))
    gone = wide.where("v is null").join(month.select("source", F.col("month"), F.col("level").alias("month_level")), (F.col("month") == F.trunc("day", "month")) & month["source"].eqNullSafe(wide["source"]), "left").drop(month["source"])
    gone = gone.join(F.broadcast(pattern.select("cluster", "mo", "dow", "r")), ["cluster", "mo", "dow"], "left").join(F.broadcast(week), ["cluster", "dow"], "left")
    gone = gone.join(F.broadcast(groups_), gone["cluster"].eqNullSafe(groups_["cluster"]), "left").drop(groups_["cluster"]).crossJoin(F.broadcast(whole))
    ways = (
        ("entity month x cluster weekday", F.col("month_level") * F.col("r7")),
        ("entity x cluster month and weekday", F.col("level") * F.col("r")),
        ("entity x cluster weekday", F.col("level") * F.col("r7")),
        ("entity", F.col("middle")),
        ("cluster", F.when(F.col("cluster").isNotNull(), F.col("cluster_middle"))),
        ("all", F.col("all_middle")),
    )
    filled = gone.select("row_key", "source", "day", F.coalesce(*[v for _, v in ways]).alias("v"), F.coalesce(*[v for _, v in ways]).isNotNull().alias("is_filled"), F.coalesce(*[F.when(v.isNotNull(), n) for n, v in ways], F.lit("none")).alias("method"))
    kept = rows.where("v is not null").select("row_key", "source", "day", "v", F.lit(False).alias("is_filled"), F.lit("observed").alias("method"))
    return kept.unionByName(filled)


def fill_texts(df: DataFrame, key: str, entity: str, valid: Mapping[str, Sequence[str]], numeric: Sequence[str] = (), others: Sequence[str] = ()) -> DataFrame:
    """(key, entity, column_name, value, is_filled, method): one row per distinct row and column of ``valid`` (column -> its few valid values).
    ``numeric`` and ``others``: further features of the entity."""
    require(df, key, entity, *valid, *numeric, *others)
    names = list(valid)
    for c, v in valid.items():
        if len(v) > 100:
            raise ValueError(f"{c} has {len(v)} valid values; at most 100 can be counted by column")
    rows = df.select(col(key).alias("row_key"), col(entity).cast("string").alias("source"), *[valid_text(col(c).cast("string"), v).alias(f"t{i}") for i, (c, v) in enumerate(valid.items())], *[F.when(present(df, c), col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(numeric)], *[col(c).cast("string").alias(f"o{i}") for i, c in enumerate(others)]).distinct()
    rows = cut(rows)
    counts = [F.count(F.when(F.col(f"t{i}") == v, 1)).alias(f"t{i}_{j}") for i, c in enumerate(names) for j, v in enumerate(valid[c])]
    ents = rows.groupBy("source").agg(*counts, *[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(numeric))], *[F.min(f"o{i}").alias(f"o{i}") for i in range(len(others))])

    def mode(of: Sequence[Column], values: Sequence[str]) -> Column:
        """The most frequent value, ties by the order of the list; null if there is none."""
        best = F.array_max(F.array(*[F.struct(n.alias("n"), F.lit(-j).alias("j"), F.lit(v).alias("v")) for j, (n, v) in enumerate(zip(of, values))]))
        return F.when(best["n"] > 0, best["v"])

    modes = [mode([F.col(f"t{i}_{j}") for j in range(len(valid[c]))], valid[c]).alias(f"mode{i}") for i, c in enumerate(names)]
    ents = cut(ents.select("*", *modes))
    clustered = kprototypes(ents, [f"x{i}" for i in range(len(numeric))], [f"mode{i}" for i in range(len(names))] + [f"o{i}" for i in range(len(others))], CLUSTERS)
    clustered = clustered.withColumn("cluster", F.when(F.col("source").isNotNull(), F.col("cluster")))
    sums = [F.sum(f"t{i}_{j}").alias(f"t{i}_{j}") for i, c in enumerate(names) for j in range(len(valid[c]))]
    per = bounded_rows(clustered.groupBy("cluster").agg(*sums), CLUSTERS + 1, "clusters")  # a row a cluster

    def best(rows_: Sequence, i: int, c: str) -> str | None:
        n = [sum(r[f"t{i}_{j}"] or 0 for r in rows_) for j in range(len(valid[c]))]
        return valid[c][n.index(max(n))] if max(n, default=0) > 0 else None

    parts = []
    for i, c in enumerate(names):
        of_cluster = F.lit(None).cast("string")
        for r in per:
            if r["cluster"] is not None and (v := best([r], i, c)) is not None:
                of_cluster = F.when(F.col("cluster") == r["cluster"], v).otherwise(of_cluster)
        own = F.when(F.col("source").isNotNull(), F.col(f"mode{i}"))
        ways = (("entity", own), ("cluster", of_cluster), ("all", F.lit(best(per, i, c)).cast("string")))
        parts.append(F.struct(F.lit(c).alias("column_name"), F.coalesce(*[v for _, v in ways]).alias("fill"), F.coalesce(*[F.when(v.isNotNull(), n) for n, v in ways], F.lit("none")).alias("how")))
    answers = clustered.select("source", F.array(*parts).alias("answers"))
    got = rows.join(answers.hint("shuffle_hash"), rows["source"].eqNullSafe(answers["source"]), "left").drop(answers["source"])
    cells = F.arrays_zip(F.array(*[F.col(f"t{i}") for i in range(len(names))]).alias("seen"), F.col("answers"))
    got = got.select("row_key", "source", F.explode(cells).alias("x"))
    gone = F.col("x.seen").isNull()
    return got.select("row_key", "source", F.col("x.answers.column_name").alias("column_name"), F.coalesce("x.seen", "x.answers.fill").alias("value"), (gone & F.col("x.answers.fill").isNotNull()).alias("is_filled"), F.when(gone, F.col("x.answers.how")).otherwise("observed").alias("method"))
