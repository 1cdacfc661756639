"""Queries for the general data problems, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.common import cut
from tidegrid.operators.fill import fill_numbers, fill_texts
from tidegrid.operators.grid import regular_days
from tidegrid.operators.profile import DECIMALS, TRUE, Rule, departures, load_profile, quality_profile, stability, texts, value_counts
from tidegrid.operators.rolling import build_trees, correct_trees, daily_totals, rolling_from_trees, rolling_totals
from tidegrid.operators.spikes import implausible_rows, score_readings

STORE_TYPES = ("city", "mall", "kiosk", "depot")
ASSORTMENTS = ("core", "wide", "full")
PROMO_INTERVALS = ("Jan,May,Sep", "Feb,Jun,Oct", "Mar,Jul,Nov", "Apr,Aug,Dec")
TS_RULES = (Rule("y_clean", None, DECIMALS), Rule("is_short_series", None, TRUE))
PANEL_RULES = (Rule("PromoInterval", "|".join(PROMO_INTERVALS), texts(*PROMO_INTERVALS)),)


def _ts(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/ts_preprocessed.parquet")


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/rossmann_panel.parquet")


def _text(day: str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def p1_rolling(spark: SparkSession, d: str) -> DataFrame:
    got = rolling_totals(_ts(spark, d), "time_series_id", "ds", "y_clean", (7, 30), ["row_id"])
    return got.select("time_series_id", _text("ds").alias("ds"), *[e for p in (7, 30) for e in (F.round(f"total_{p}", 6).alias(f"total_{p}"), F.round(f"avg_{p}", 6).alias(f"avg_{p}"), F.col(f"count_{p}"))])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    got = rolling_totals(_ts(spark, d), "time_series_id", "ds", "y_clean", (7, 30), ["row_id"], where=F.expr("count_7 = 0 and count_30 > 0"))
    return got.select("time_series_id", _text("ds").alias("ds"))


def p1_long(spark: SparkSession, d: str) -> DataFrame:
    """Periods that reach over several shards."""
    got = rolling_totals(_ts(spark, d), "time_series_id", "ds", "y_clean", (90, 365), ["row_id"])
    return got.select("time_series_id", _text("ds").alias("ds"), *[e for p in (90, 365) for e in (F.round(f"total_{p}", 4).alias(f"total_{p}"), F.col(f"count_{p}"))])


def p1_corrected(spark: SparkSession, d: str) -> DataFrame:
    """Trees of all loads but the last are stored; the last load corrects them; the corrected trees answer as if all rows had been there."""
    last = F.broadcast(_ts(spark, d).agg(F.max("load_id").alias("last_load")))
    rows = _ts(spark, d).crossJoin(last)
    daily = lambda which: daily_totals(rows.where(which), "time_series_id", "ds", "y_clean", ["row_id"])
    trees = cut(build_trees(daily("load_id < last_load or load_id is null")))
    got = rolling_from_trees(correct_trees(trees, daily("load_id = last_load")), (7, 30), "time_series_id", "ds")
    return got.select("time_series_id", _text("ds").alias("ds"), *[e for p in (7, 30) for e in (F.round(f"total_{p}", 6).alias(f"total_{p}"), F.round(f"avg_{p}", 6).alias(f"avg_{p}"), F.col(f"count_{p}"))])


def p2_profile(spark: SparkSession, d: str) -> DataFrame:
    ts, panel = _ts(spark, d), _panel(spark, d)
    a = quality_profile(ts, "load_id", [c for c in ts.columns if c != "load_id"], TS_RULES).select(F.lit("ts_preprocessed").alias("table_name"), "*")
    b = quality_profile(panel, "load_id", [c for c in panel.columns if c != "load_id"], PANEL_RULES).select(F.lit("rossmann_panel").alias("table_name"), "*")
    return a.unionByName(b)


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = value_counts(_panel(spark, d), "load_id", ["StoreType", "Assortment", "PromoInterval", "StateHoliday", "y"])
    return load_profile(counts, PANEL_RULES).select("column_name", "load_id", "n_rows", "n_missing", "n_distinct", "min_value", "max_value", "n_ill_formed")


#: Columns whose ranges are compared with SQL as numbers; the others are compared as texts.
NUMBERS = {"ts_preprocessed": ("row_id", "y", "product_wavg_unit_price", "y_clean", "is_inactive", "series_length"), "rossmann_panel": ("reading_id", "y", "Promo")}
TEXTS = {"ts_preprocessed": ("time_series_id", "soldto_id", "item_id", "ds", "y_is_outlier", "is_obsolete", "series_min_date", "series_max_date", "is_short_series", "table_update_datetime"),
         "rossmann_panel": ("time_series_id", "StateHoliday", "StoreType", "Assortment", "PromoInterval", "is_short_series")}


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"ts_preprocessed": _ts(spark, d), "rossmann_panel": _panel(spark, d)}


def p2_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Rows, missing cells, distinct values and ranges of every column but the times of rossmann_panel, by load."""
    out = None
    for name, df in _tables(spark, d).items():
        got = load_profile(value_counts(df, "load_id", [*NUMBERS[name], *TEXTS[name]]))
        number = F.col("column_name").isin(*NUMBERS[name])
        cols = [F.when(number, F.expr(f"cast({m}_value as double)")).alias(f"{m}_number") for m in ("min", "max")] + [F.when(~number, F.col(f"{m}_value")).alias(f"{m}_text") for m in ("min", "max")]
        got = got.select(F.lit(name).alias("table_name"), "column_name", "load_id", "n_rows", "n_missing", "n_distinct", *cols)
        out = got if out is None else out.unionByName(got)
    return out


def p2_stability(spark: SparkSession, d: str) -> DataFrame:
    """PSI and chi-square of the numbers of every load against those of all others."""
    out = None
    for name, df in _tables(spark, d).items():
        got = stability(value_counts(df, "load_id", NUMBERS[name])).select(F.lit(name).alias("table_name"), "column_name", "load_id", F.round("psi", 5).alias("psi"), F.round("chi2", 2).alias("chi2"))
        out = got if out is None else out.unionByName(got)
    return out


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    # a row for each load and column, written once: three branches of departures read it, and each would scan the table anew
    a = departures(cut(load_profile(value_counts(_ts(spark, d), "load_id", ["y_clean", "is_short_series"]), TS_RULES)))
    b = departures(cut(load_profile(value_counts(_panel(spark, d), "load_id", ["PromoInterval"]), PANEL_RULES)))
    both = a.withColumn("table_name", F.lit("ts_preprocessed")).unionByName(b.withColumn("table_name", F.lit("rossmann_panel")))
    return both.select("table_name", "column_name", "load_id", "kind")


def p4_grid(spark: SparkSession, d: str) -> DataFrame:
    got = regular_days(_panel(spark, d), "time_series_id", "ds", "y")
    return got.select("time_series_id", _text("day").alias("grid_day"), F.round("y", 4).alias("y"), "n_readings", "status")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    got = regular_days(_panel(spark, d), "time_series_id", "ds", "y").where("status <> 'observed'")
    return got.select("time_series_id", _text("day").alias("grid_day"))


def p5_scores(spark: SparkSession, d: str) -> DataFrame:
    a = score_readings(_ts(spark, d), "time_series_id", "ds", "y_clean", True).withColumn("table_name", F.lit("ts_preprocessed"))
    b = score_readings(_panel(spark, d), "time_series_id", "ds", "y", False).withColumn("table_name", F.lit("rossmann_panel"))
    both = a.withColumn("t", F.col("t").cast("timestamp_ntz")).unionByName(b.withColumn("t", F.col("t").cast("timestamp_ntz")))
    return both.select("table_name", F.col("source").alias("time_series_id"), F.col("t").alias("ds"), F.col("v").alias("value"), "level", "run", F.round("score", 6).alias("score"), "kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    a = implausible_rows(_ts(spark, d), "time_series_id", "ds", "y_clean", "row_id", True).select(F.lit("ts_preprocessed").alias("table_name"), "row_key")
    b = implausible_rows(_panel(spark, d), "time_series_id", "ds", "y", "reading_id", False).select(F.lit("rossmann_panel").alias("table_name"), "row_key")
    return a.unionByName(b)


def _fills(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = fill_numbers(_ts(spark, d), "row_id", "time_series_id", "ds", "y_clean", ["soldto_id"])
    b = fill_texts(_panel(spark, d), "reading_id", "time_series_id", {"StoreType": STORE_TYPES, "Assortment": ASSORTMENTS}, ["y", "Promo"], ["PromoInterval"])
    return a, b


def p7_filled(spark: SparkSession, d: str) -> DataFrame:
    a, b = _fills(spark, d)
    a = a.select(F.lit("ts_preprocessed").alias("table_name"), "row_key", F.lit("y_clean").alias("column_name"), F.round("v", 4).cast("string").alias("value"), "is_filled", "method")
    return a.unionByName(b.select(F.lit("rossmann_panel").alias("table_name"), "row_key", "column_name", "value", "is_filled", "method"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = _fills(spark, d)
    a = a.where("method <> 'observed'").select(F.lit("ts_preprocessed").alias("table_name"), "row_key", F.lit("y_clean").alias("column_name"))
    return a.unionByName(b.where("method <> 'observed'").select(F.lit("rossmann_panel").alias("table_name"), "row_key", "column_name")).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_rolling, p1_found, p1_long, p1_corrected, p2_profile, p2_counts, p2_ranges, p2_stability, p2_found, p4_grid, p4_found, p5_scores, p5_found, p7_filled, p7_found)}


_CAL = """with d as (select time_series_id g, ds, sum(case when not isnan(y_clean) then y_clean end) s, count(case when not isnan(y_clean) then 1 end) c
  from (select distinct row_id, time_series_id, ds, y_clean from ts_preprocessed) group by 1, 2),
b as (select g, min(ds) lo, max(ds) hi from d group by 1),
cal as (select g, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) ds from b),
w as (select cal.g time_series_id, strftime(cal.ds, '%Y-%m-%d') ds, coalesce(sum(s) over w7, 0) t7, cast(coalesce(sum(c) over w7, 0) as bigint) count_7,
  coalesce(sum(s) over w30, 0) t30, cast(coalesce(sum(c) over w30, 0) as bigint) count_30 from cal left join d on cal.g = d.g and cal.ds = d.ds
  window w7 as (partition by cal.g order by cal.ds rows 6 preceding), w30 as (partition by cal.g order by cal.ds rows 29 preceding))
"""


def _spikes(table: str, key: str, y: str, bad: str) -> str:
    there = f"{y} is not null and ds is not null and time_series_id is not null" + (" and not isnan(y_clean)" if y == "y_clean" else "")
    return f"""select '{table}' table_name, r.{key} row_key from (select distinct {key}, time_series_id, ds, {y} v from {table} where {there}) r join (
 with u as (select distinct time_series_id, ds, {y} v from {table} where {there}),
 l as (select *, median(v) over (partition by time_series_id order by ds, v rows between 7 preceding and 7 following exclude current row) lvl from u where v > 0),
 i as (select *, case when v = lag(v) over (partition by time_series_id order by ds, v) then 0 else 1 end fresh from u),
 n as (select *, sum(fresh) over (partition by time_series_id order by ds, v rows unbounded preceding) isle from i),
 k as (select *, count(*) over (partition by time_series_id, isle) run, min(v) over (partition by time_series_id) lo, max(v) over (partition by time_series_id) hi from n)
 select time_series_id, ds, v from u where {bad} union select time_series_id, ds, v from l where v > 3 * lvl or v * 3 < lvl
 union select time_series_id, ds, v from k where run >= 6 and v <> 0 and lo < hi) c on r.time_series_id = c.time_series_id and r.ds = c.ds and r.v = c.v"""


def _shares(table: str, column: str, gone: str, groups: dict[str, str]) -> str:
    parts = [f"select load_id, 'missing' kind, 'missing' g, 0.2 far, avg(case when {gone} then 1.0 else 0.0 end) share from {table} group by load_id"]
    parts += [f"select load_id, 'shift' kind, '{n}' g, 0.35 far, avg(case when {c} then 1.0 else 0.0 end) share from {table} where not ({gone}) group by load_id" for n, c in groups.items()]
    return f"""select distinct '{table}' table_name, '{column}' column_name, load_id, kind from (select *, median(share) over (partition by kind, g) usual from ({" union all ".join(parts)})) where abs(share - usual) >= far - 1e-9"""


def _there(c: str) -> str:
    """The cell as a number, null where it is null or NaN."""
    return f"(case when not isnan(cast({c} as double)) then cast({c} as double) end)"


def _range(table: str, c: str, number: bool) -> str:
    x = _there(c) if number else f"cast({c} as varchar)"
    ends = [f"{m}({x}) {m}_number, cast(null as varchar) {m}_text" if number else f"cast(null as double) {m}_number, {m}({x}) {m}_text" for m in ("min", "max")]
    return f"select '{table}' table_name, '{c}' column_name, load_id, count(*) n_rows, count(*) - count({x}) n_missing, count(distinct {x}) n_distinct, {', '.join(ends)} from {table} group by load_id"


def _psi(table: str, c: str) -> str:
    x = _there(c)
    return f"""select '{table}' table_name, '{c}' column_name, load_id, round(sum((p - q) * ln(p / q)), 5) psi, round(sum((n - q * of) ** 2 / (q * of)), 2) chi2 from (
 select *, (n + 0.5) / (of + 0.5 * k) p, (bin_n - n + 0.5) / (all_n - of + 0.5 * k) q from (
  select l.load_id, l.of, coalesce(b.n, 0) n, sum(coalesce(b.n, 0)) over (partition by g.bin) bin_n, sum(l.of) over (partition by g.bin) all_n, count(*) over (partition by l.load_id) k
  from (select load_id, count(*) of from {table} group by 1) l cross join (select distinct {_bin(x)} bin from {table}) g
  left join (select load_id, {_bin(x)} bin, count(*) n from {table} group by 1, 2) b on l.load_id is not distinct from b.load_id and g.bin = b.bin)) group by load_id"""


def _bin(x: str) -> str:
    """Sign and binary exponent, or missing."""
    return f"case when {x} is null then 'missing' when {x} = 0 then '0' else concat(sign({x}), ' ', floor(ln(abs({x})) / ln(2.0))) end"


_TEN = "y_clean = round(y_clean, 0)"
_GOOD_DAYS = "select distinct time_series_id, cast(ds as date) d from rossmann_panel where ds is not null and y is not null and time_series_id is not null"


def _bare(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def sql() -> dict[str, str]:
    in_ = lambda v: "(" + ", ".join(f"'{x}'" for x in v) + ")"
    cells = []
    for c in ("StoreType", "Assortment", "PromoInterval", "StateHoliday", "y"):
        bad = f"count(case when {c} not in {in_(PROMO_INTERVALS)} then 1 end)" if c == "PromoInterval" else "0"
        cells.append(f"select '{c}' column_name, load_id, count(*) n_rows, count(*) - count({c}) n_missing, count(distinct {c}) n_distinct, cast(min({c}) as varchar) min_value, cast(max({c}) as varchar) max_value, {bad} n_ill_formed from rossmann_panel group by load_id")
    return {
        "p1_rolling": _CAL + ", r as (select *, case when count_7 > 0 then t7 / count_7 end a7, case when count_30 > 0 then t30 / count_30 end a30 from w) "
        "select time_series_id, ds, round(t7, 6) total_7, round(a7, 6) avg_7, count_7, round(t30, 6) total_30, round(a30, 6) avg_30, count_30 from r",
        "p1_long": _CAL.replace("rows 6 preceding", "rows 89 preceding").replace("rows 29 preceding", "rows 364 preceding")
        + "select time_series_id, ds, round(t7, 4) total_90, count_7 count_90, round(t30, 4) total_365, count_30 count_365 from w",
        "p1_corrected": _CAL + ", r as (select *, case when count_7 > 0 then t7 / count_7 end a7, case when count_30 > 0 then t30 / count_30 end a30 from w) "
        "select time_series_id, ds, round(t7, 6) total_7, round(a7, 6) avg_7, count_7, round(t30, 6) total_30, round(a30, 6) avg_30, count_30 from r",
        "p1_found": _CAL + "select time_series_id, ds from w where count_7 = 0 and count_30 > 0",
        "p2_counts": " union all ".join(cells),
        "p2_ranges": " union all ".join(_range(t, c, c in NUMBERS[t]) for t in NUMBERS for c in (*NUMBERS[t], *TEXTS[t])),
        "p2_stability": " union all ".join(_psi(t, c) for t in NUMBERS for c in NUMBERS[t]),
        "p2_found": " union all ".join([
            _shares("ts_preprocessed", "y_clean", "y_clean is null or isnan(y_clean)", {"0": _TEN, "1": f"y_clean = round(y_clean, 1) and not {_TEN}", "2": "y_clean = round(y_clean, 2) and y_clean <> round(y_clean, 1)"}),
            _shares("ts_preprocessed", "is_short_series", "is_short_series is null", {"true": "is_short_series"}),
            _shares("rossmann_panel", "PromoInterval", "PromoInterval is null", {v: f"PromoInterval = '{v}'" for v in PROMO_INTERVALS}),
            f"select distinct 'rossmann_panel', 'PromoInterval', load_id, 'domain' from rossmann_panel where PromoInterval not in {in_(PROMO_INTERVALS)}",
        ]),
        "p4_found": f"""with u as ({_GOOD_DAYS}), b as (select time_series_id, min(d) lo, max(d) hi from u group by 1),
 cal as (select time_series_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) d from b)
 select time_series_id, strftime(d, '%Y-%m-%d') grid_day from cal anti join u using (time_series_id, d)""",
        "p5_found": _spikes("ts_preprocessed", "row_id", "y_clean", "v < 0") + " union all " + _spikes("rossmann_panel", "reading_id", "y", "v <= 0"),
        "p7_found": f"""select distinct 'ts_preprocessed' table_name, row_id row_key, 'y_clean' column_name from ts_preprocessed where y_clean is null or isnan(y_clean)
 union all select distinct 'rossmann_panel', reading_id, 'StoreType' from rossmann_panel where StoreType is null or {_bare("StoreType")} not in {in_(STORE_TYPES)}
 union all select distinct 'rossmann_panel', reading_id, 'Assortment' from rossmann_panel where Assortment is null or {_bare("Assortment")} not in {in_(ASSORTMENTS)}""",
    }
