"""Column-level data quality: an exact profile from column-value counts, and the loads in which a column departs.

The table is unpivoted into (load, column, value) and counted, map-side first, so that a value held by a third of all rows
is a single pre-aggregated row before the shuffle. Everything else is derived from those counts.

Defined results: nulls and NaN are missing; blank texts are values; rows are counted as they are, duplicates included; a load
without a present value has no shares (null) and takes no part in medians of shares; a null load id is a load of its own;
an empty table gives an empty profile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.common import col, cut, is_float, require

BINS = 64
EPS = 1e-9
#: A distribution departs from a PSI of PSI_BY on (the customary mark of a major change), if chance alone gives its chi-square once in a thousand times at most (CHI2_Z as a normal deviate).
PSI_BY, CHI2_Z = 0.25, 3.09


@dataclass(frozen=True)
class Rule:
    """What is known of a column: a pattern that well-formed texts match in full; groups of values whose shares are watched,
    as (name, SQL condition over ``text`` and ``num``)."""

    column: str
    pattern: str | None = None
    groups: Sequence[tuple[str, str]] = field(default_factory=tuple)


#: A number needs exactly d decimals: rounding to d leaves it as it is, rounding to d - 1 does not.
DECIMALS = (
    ("0 decimals", "num = round(num, 0)"),
    ("1 decimal", "num = round(num, 1) and num <> round(num, 0)"),
    ("2 decimals", "num = round(num, 2) and num <> round(num, 1)"),
)
TRUE = (("true", "text = 'true'"),)


def texts(*values: str) -> tuple[tuple[str, str], ...]:
    return tuple((v, "text = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "'") for v in values)


def _exact(df: DataFrame, name: str) -> tuple[str, str] | None:
    """The column in which the exact values of an integer or decimal column stand, one for each scale, and its type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return f"exact_{kind.scale}", f"decimal(38,{kind.scale})"
    return ("exact_int", "bigint") if isinstance(kind, T.IntegralType) else None


def value_counts(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """(load_id, column_name, text, num, exact_*, n): how often each value occurs. Numbers of any type stand in num, those that are no floating numbers also
    exactly in ``exact_*`` and as they are written in text; all else stands in text; missing is null in all."""
    require(df, load, *columns)
    exact = {c: e for c in columns if (e := _exact(df, c))}
    kinds = dict(exact.values())

    def cell(c: str) -> Column:
        x = col(c)
        text = F.lit(None).cast("string") if is_float(df, c) or c in exact else x.cast("string")
        num = F.when(~F.isnan(x), x.cast("double")) if is_float(df, c) else F.lit(None).cast("double")
        whole = [(x if c in exact and exact[c][0] == e else F.lit(None)).cast(kind).alias(e) for e, kind in kinds.items()]
        return F.struct(F.lit(c).alias("column_name"), text.alias("text"), num.alias("num"), *whole)

    cells = df.select(col(load).alias("load_id"), F.explode(F.array(*map(cell, columns))).alias("x")) if len(columns) > 1 else df.select(col(load).alias("load_id"), cell(columns[0]).alias("x"))
    counts = cells.groupBy("load_id", "x.column_name", "x.text", "x.num", *(f"x.{e}" for e in kinds)).agg(F.count("*").alias("n"))
    read = lambda c, kind: F.coalesce(c, *(F.col(e).cast(kind) for e in kinds)).alias(c)
    return counts.select("load_id", "column_name", read("text", "string"), read("num", "double"), *kinds, "n")


_GONE = "text is null and num is null"


def load_profile(counts: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """One row per load and column: rows, missing, distinct values, range (of numbers by size, of texts by order), ill-formed values, and the map of watched shares."""
    by_size = [*(c for c in counts.columns if c.startswith("exact_")), "num"]
    bad = F.lit(False)
    groups = []
    for r in rules:
        here = F.col("column_name") == r.column
        if r.pattern:
            bad = bad | (here & ~F.col("text").rlike(rf"\A(?:{r.pattern})\z"))
        groups += [F.when(F.max(here), F.struct(F.lit(g).alias("group"), F.coalesce(F.sum(F.when(here & F.expr(sql), F.col("n"))), F.lit(0)).alias("n"))) for g, sql in r.groups]
    return counts.groupBy("load_id", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.expr(_GONE), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count(F.when(~F.expr(_GONE), 1)).alias("n_distinct"),
        F.coalesce(*(F.min(c).cast("string") for c in by_size), F.min("text")).alias("min_value"),
        F.coalesce(*(F.max(c).cast("string") for c in by_size), F.max("text")).alias("max_value"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n_ill_formed"),
        (F.filter(F.array(*groups), lambda g: g.isNotNull()) if groups else F.array().cast("array<struct<group:string,n:bigint>>")).alias("groups"),
    )


def departures(profile: DataFrame, missing_by: float = 0.20, shift_by: float = 0.35) -> DataFrame:
    """(column_name, load_id, kind): ``missing`` and ``shift`` where a share lies at least so far from the median of that share over
    all loads, ``domain`` where a load holds ill-formed values. The medians are over loads, not rows: a small exact aggregate."""
    def far(shares: DataFrame, kind: str, by: float) -> DataFrame:
        med = shares.groupBy("column_name", "group").agg(F.median("share").alias("usual"))
        return shares.join(med, ["column_name", "group"]).where(F.abs(F.col("share") - F.col("usual")) >= by - EPS).select("column_name", "load_id", F.lit(kind).alias("kind"))

    gone = profile.select("column_name", "load_id", F.lit("missing").alias("group"), (F.col("n_missing") / F.col("n_rows")).alias("share"))
    there = F.col("n_rows") - F.col("n_missing")
    held = profile.where(there > 0).select("column_name", "load_id", there.alias("there"), F.explode("groups").alias("g")).select("column_name", "load_id", "g.group", (F.col("g.n") / F.col("there")).alias("share"))
    domain = profile.where("n_ill_formed > 0").select("column_name", "load_id", F.lit("domain").alias("kind"))
    return far(gone, "missing", missing_by).unionByName(far(held, "shift", shift_by)).unionByName(domain).distinct()


def stability(counts: DataFrame) -> DataFrame:
    """(load_id, column_name, psi, chi2, changed, changed_present): each load's distribution against that of all other loads, and whether it departs, with the missing
    and among present values. For that it is set against the usual loads, which are those with a PSI up to the median of the column (else one foreign load
    would make all others seem foreign); without another usual load, against all others. Bins need no pass over the data:
    sign and binary exponent for numbers, one of BINS hash buckets for texts, one bin for missing. Half a row is added to each bin."""
    bin_ = F.when(F.expr(_GONE), "missing").when(F.col("num").isNotNull(), F.concat(F.signum("num").cast("string"), F.coalesce(F.floor(F.log2(F.abs(F.nullif(F.col("num"), F.lit(0.0))))).cast("string"), F.lit("")))).otherwise(F.pmod(F.xxhash64("text"), F.lit(BINS)).cast("string"))
    b = counts.groupBy("column_name", bin_.alias("bin"), "load_id").agg(F.sum("n").alias("n"))
    bins = b.select("column_name", "bin").distinct()
    loads = b.groupBy("column_name", "load_id").agg(F.sum("n").alias("of"))
    grid = loads.join(bins, "column_name").alias("a").join(b.alias("b"), F.expr("a.column_name = b.column_name and a.bin = b.bin and a.load_id <=> b.load_id"), "left").select("a.column_name", "a.load_id", "a.bin", "a.of", F.coalesce("b.n", F.lit(0)).alias("n"))
    all_ = Window.partitionBy("column_name", "bin")
    k = F.count("*").over(Window.partitionBy("column_name", "load_id"))
    grid = grid.select("*", F.sum("n").over(all_).alias("bin_n"), F.sum("of").over(all_).alias("all_n"), k.alias("k"))
    p = (F.col("n") + 0.5) / (F.col("of") + 0.5 * F.col("k"))
    q = (F.col("bin_n") - F.col("n") + 0.5) / (F.col("all_n") - F.col("of") + 0.5 * F.col("k"))
    own = Window.partitionBy("column_name", "load_id")
    grid = grid.select("*", ((p - q) * F.log(p / q)).alias("psi_part"), ((F.col("n") - q * F.col("of")) ** 2 / (q * F.col("of"))).alias("chi2_part")).withColumn("psi", F.sum("psi_part").over(own))
    grid = grid.withColumn("usual", (F.col("psi") <= F.median("psi").over(Window.partitionBy("column_name")) + EPS).cast("int"))
    grid = grid.withColumns({f"usual_{c}": F.sum(F.col(c) * F.col("usual")).over(all_) - F.col(c) * F.col("usual") for c in ("n", "of")})
    grid = grid.withColumn("m", F.when(F.col("usual_of") > 0, F.col("usual_n")).otherwise(F.col("bin_n") - F.col("n")).cast("double"))
    here = {"changed": F.lit(True), "changed_present": F.col("bin") != "missing"}
    grid = grid.withColumns({f"{x}_{kind}": F.sum(F.when(w, F.col(x)).cast("double")).over(own) for kind, w in here.items() for x in "nm"} | {f"k_{kind}": F.count(F.when(w, 1)).over(own) for kind, w in here.items()})

    def changed(kind: str, where: Column) -> Column:
        n, m, of, of_m, k = (F.col(c) for c in ("n", "m", f"n_{kind}", f"m_{kind}", f"k_{kind}"))
        p, q = (n + 0.5) / F.nullif(of + 0.5 * k, F.lit(0.0)), (m + 0.5) / F.nullif(of_m + 0.5 * k, F.lit(0.0))
        psi = F.sum(F.when(where, (p - q) * F.log(p / q)))
        chi2 = F.sum(F.when(where, (n * of_m - m * of) ** 2 / F.nullif((n + m) * of * of_m, F.lit(0.0))))  # of two samples
        df = F.nullif((F.count(F.when(where & (n + m > 0), 1)) - 1).cast("double"), F.lit(0.0))
        least = df * (1 - 2 / (9 * df) + CHI2_Z * F.sqrt(F.abs(2 / (9 * df)))) ** 3  # Wilson and Hilferty
        return F.coalesce((df > 0) & (psi >= PSI_BY - EPS) & (chi2 >= least), F.lit(False)).alias(kind)

    return grid.groupBy("load_id", "column_name").agg(F.first("psi").alias("psi"), F.sum("chi2_part").alias("chi2"), *(changed(kind, w) for kind, w in here.items()))


def quality_profile(df: DataFrame, load: str, columns: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """The whole report, one row per load and column, with psi, chi2 and the kinds of departure: those of ``departures`` and, for every column, ``distribution``,
    where ``stability`` finds a change that the kind ``missing`` does not name already. A column whose values are others in each load by nature, as a load time, departs
    in each. The counts are made once and written (``cut``): three branches read them, each other columns, so that no exchange would serve all."""
    counts = cut(value_counts(df, load, columns))
    prof = load_profile(counts, rules)
    kinds = departures(prof).groupBy("column_name", "load_id").agg(F.collect_set("kind").alias("kinds"))
    on = lambda a, b: F.expr(f"{a}.column_name = {b}.column_name and {a}.load_id <=> {b}.load_id")
    got = prof.alias("p").join(stability(counts).alias("s"), on("p", "s"), "left").join(kinds.alias("k"), on("p", "k"), "left")
    kinds = F.coalesce("kinds", F.array().cast("array<string>"))
    changed = F.col("changed_present") | (F.col("changed") & ~F.array_contains(kinds, "missing"))
    departs = F.array_join(F.array_sort(F.when(changed, F.array_append(kinds, F.lit("distribution"))).otherwise(kinds)), ",")
    return got.select("p.column_name", "p.load_id", "n_rows", "n_missing", (F.col("n_missing") / F.col("n_rows")).alias("missing_share"), "n_distinct", "min_value", "max_value", "n_ill_formed", "psi", "chi2", departs.alias("departs"))
